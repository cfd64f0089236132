"""The five gold marts: ``build(silver, as_of=None) -> DataFrame`` each, full recompute."""

from medallion.plans.gold import (
    freezer_utilization,
    lab_performance,
    sample_tracking,
    shipment_sla,
    study_enrollment,
)

# Build order of the reference's gold driver.
MARTS = {
    m.NAME: m
    for m in (sample_tracking, lab_performance, shipment_sla, study_enrollment, freezer_utilization)
}
