"""Information-theoretic sanitisation of personal data. DataFrame functions only.

Base entities are e-mail addresses, IP addresses, card and phone numbers, found by regular
expressions, leftmost and non-overlapping per kind (the expressions below find what the plain
ones of the contract find, in linear time: possessive repeats, and no start inside a run that
has failed). A kind's places follow from the lengths of the gaps between its matches.

Documents are the contexts. For an entity e (its normalised value) and a term t (a word, lower-cased, without outer
punctuation), over the D documents of the corpus, of which n(e) have e, n(t) have t and n(e,t) have both:

    IC(e)    = log2(D / n(e))                     what e tells
    PMI(e;t) = log2(n(e,t) * D / (n(e) * n(t)))   what t tells about e

t reveals e by PMI/IC, which is 1 where t is found only with e. From ``GENERALISE`` on its uses in the documents of e are
generalised (``<TERM>``), from ``REMOVE`` on removed, wherever they stand in the whole text. Which terms are judged:

* of an entity in ``SUPPORT`` different texts or more, every term that shares so many texts with it;
* of a rarer one, whose every rare word would be found with it by chance, the terms beside its mentions: the
  ``BESIDE`` words with a letter on either side, within ``CONTEXT`` code points (cut words left out). Other numbers do not end a
  context. n(e,t) then counts the documents where t is beside e, which is never too many.

Copies of a text are one text for ``SUPPORT`` and weigh alike on both sides of the ratio. Counts cover whole texts of all
documents, with a partial step on the map side; the terms that can reveal anything are selected before they are joined.

Null texts count as empty and have no spans. Rows are independent, repeated rows get the same spans; terms of equal ratio
are treated alike, so there are no ties. An empty table has no spans; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm.common import BLANK_CLASS, col, fresh, keyed, read_table, stage, text_or_empty
from medallion.llm.quality import words_of

LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BASE = list(PATTERNS)
KINDS = [*BASE, "generalise", "remove"]
PUNCTUATION = ".,;:!?()[]{}<>|\"'*#$%&+-/=_~`^\\@"
CONTEXT, BESIDE = 60, 3
#: Matches of its own kind over which a mention's context may reach.
REACH = 8
SUPPORT = 3
GENERALISE, REMOVE = 0.9, 1.0


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _valid(kind: Column, m: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
    n = F.length(_digits(m))
    return (
        F.when(kind == "ip", m.rlike(rf"^{part}(?:\.{part}){{3}}$"))
        .when(kind == "card", n.between(13, 19) & F.call_function("luhn_check", _digits(m)))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(True)
    )


def mentions(df: DataFrame, text: str, rid: str) -> DataFrame:
    """rid, kind, start, end (code points, end exclusive), entity, text_id (digest), before, after (contexts, cut words left out)."""
    rows = df.select(col(rid).alias("rid"), text_or_empty(text).alias("t"))
    rows = rows.select("rid", "t", *[F.regexp_extract_all("t", F.lit(p), F.lit(0)).alias(f"m_{k}") for k, p in PATTERNS.items()])
    rows = rows.filter(" OR ".join(f"size(m_{k}) > 0" for k in BASE))
    text_id = F.sha2(F.col("t").cast("binary"), 256).alias("text_id")
    rows = rows.select("rid", text_id, *[f"m_{k}" for k in BASE], *[F.when(F.size(f"m_{k}") > 0, F.split("t", p, -1)).alias(f"g_{k}") for k, p in PATTERNS.items()])

    def near(k: str, first: Column, n: Column) -> Column:
        """Gaps and matches from gap ``first`` on, ``n`` of each, as one text (a gap's far part may be left out)."""
        gaps = F.slice(F.col(f"g_{k}"), first + 1, n)
        short = lambda g: F.when(F.length(g) > 2 * CONTEXT + 2, F.concat(F.left(g, F.lit(CONTEXT + 1)), F.right(g, F.lit(CONTEXT + 1)))).otherwise(g)
        return F.array_join(F.transform(gaps, lambda g, j: F.concat(short(g), F.coalesce(F.get(F.col(f"m_{k}"), first + j), F.lit("")))), "")

    def entries(k: str) -> Column:
        gap = lambda i: F.get(F.col(f"g_{k}"), i)
        back = lambda i: F.least(i, F.lit(REACH))
        return F.transform(
            F.col(f"m_{k}"),
            lambda m, i: F.struct(
                F.lit(k).alias("kind"), i.alias("i"), F.length(gap(i)).alias("gap"), m.alias("m"),
                F.concat(near(k, i - back(i), back(i)), gap(i)).alias("before"), near(k, i + 1, F.lit(REACH)).alias("after"),
            ),
        )

    found = rows.select("rid", "text_id", F.inline(F.concat(*[entries(k) for k in BASE])))
    sides = {"before": F.right("before", F.lit(CONTEXT + 1)), "after": F.left("after", F.lit(CONTEXT + 1))}
    found = found.withColumns(sides)  # one more than a context: a word is cut if it reaches that far
    upto = Window.partitionBy("rid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("n", F.length("m").cast("long")).withColumn("end", F.sum(F.col("gap") + F.col("n")).over(upto))
    value = F.when(F.col("kind") == "email", F.lower("m")).when(F.col("kind") == "ip", F.col("m")).otherwise(_digits(F.col("m")))
    edge = f"(?:(?!{BLANK_CLASS}).)++"
    return found.filter(_valid(F.col("kind"), F.col("m"))).select(
        "rid", "kind", (F.col("end") - F.col("n")).alias("start"), "end", F.concat_ws(":", "kind", value).alias("entity"), "text_id",
        F.when(F.length("before") > CONTEXT, F.regexp_replace("before", "(?s)^" + edge, "")).otherwise(F.col("before")).alias("before"),
        F.when(F.length("after") > CONTEXT, F.regexp_replace("after", f"(?s)(?<!(?!{BLANK_CLASS}).){edge}$", "")).otherwise(F.col("after")).alias("after"),
    )


def term_of(token: Column) -> Column:
    return F.lower(F.btrim(token, F.lit(PUNCTUATION)))


def _is_term(word: Column) -> Column:
    return word.rlike(r"\p{L}") & ~word.contains("@")


def terms_of(words: Column) -> Column:
    """Different terms with a letter among ``words`` (an array); addresses are entities, not terms."""
    return F.array_distinct(F.transform(F.filter(words, _is_term), term_of))


def pairs_beside(found: DataFrame) -> DataFrame:
    """entity, term, n_et of terms beside the mentions of an entity."""
    before, after = (F.filter(F.split(side, BLANK_CLASS), _is_term) for side in ("before", "after"))
    words = F.concat(F.slice(F.reverse(before), 1, BESIDE), F.slice(after, 1, BESIDE))
    once = found.select("rid", "entity", F.explode(terms_of(words)).alias("term")).distinct()
    return once.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_et"))


def pairs_within(rows: DataFrame, entities: DataFrame) -> DataFrame:
    """entity, term, n_et of terms in ``SUPPORT`` texts or more of an entity. ``rows``: rid, t; ``entities``: rid, entity, text_id."""
    terms = rows.join(entities.select("rid").distinct(), "rid", "left_semi").select("rid", F.explode(terms_of(words_of(F.col("t")))).alias("term"))
    both = terms.join(entities, "rid").groupBy("entity", "term", "text_id").agg(F.count(F.lit(1)).alias("n"))
    return both.groupBy("entity", "term").agg(F.sum("n").alias("n_et"), F.count(F.lit(1)).alias("texts")).filter(F.col("texts") >= SUPPORT).drop("texts")


def disclosing_terms(df: DataFrame, text: str, rid: str, found: DataFrame) -> DataFrame:
    """entity, term, ratio (PMI / IC) of the terms that reveal an entity by ``GENERALISE`` at least."""
    rows = df.select(col(rid).alias("rid"), text_or_empty(text).alias("t"))
    per_text = found.select("entity", "rid", "text_id").distinct().groupBy("entity", "text_id").agg(F.count(F.lit(1)).alias("n"))
    entities = stage(per_text.groupBy("entity").agg(F.sum("n").alias("n_e"), F.count(F.lit(1)).alias("texts")), "entities")
    often, seldom = entities.filter(F.col("texts") >= SUPPORT).select("entity"), entities.filter(F.col("texts") < SUPPORT).select("entity")
    within = pairs_within(rows, found.select("rid", "entity", "text_id").distinct().join(often, "entity"))
    pairs = within.union(pairs_beside(found.join(seldom, "entity")))
    pairs = stage(pairs.join(entities.select("entity", "n_e"), "entity"), "pairs")
    wanted = pairs.select("term").distinct()
    uses = rows.select(F.explode(terms_of(words_of(F.col("t")))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    known = pairs.join(stage(uses.join(wanted, "term", "left_semi"), "uses"), "term")
    total = F.lit(float(df.count()))
    ic = F.log2(total / F.col("n_e"))
    ratio = 1 + F.log2(F.col("n_et") / F.col("n_t")) / ic  # PMI = IC + log2(n(e,t) / n(t))
    return known.filter(ic > 0).select("entity", "term", ratio.alias("ratio")).filter(F.col("ratio") >= GENERALISE)


def term_places(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """rid, start, end, ratio of every use of a document's ``chosen`` terms (rid, term, ratio). ``rows``: rid, t.

    Words lie between single blanks, so a word's place is the sum of the lengths before it."""
    marked = rows.join(chosen.select("rid").distinct(), "rid", "left_semi")
    words = marked.select("rid", F.posexplode(F.split("t", BLANK_CLASS, -1)).alias("j", "token"))
    before = Window.partitionBy("rid").orderBy("j").rowsBetween(Window.unboundedPreceding, -1)
    words = words.withColumn("at", F.coalesce(F.sum(F.length("token") + 1).over(before), F.lit(0)).cast("long")).withColumn("term", term_of(F.col("token")))
    first = F.col("at") + F.length("token") - F.length(F.ltrim("token", F.lit(PUNCTUATION)))
    return words.join(chosen, ["rid", "term"]).select("rid", first.alias("start"), (first + F.length("term")).alias("end"), "ratio")


def spans(df: DataFrame, text: str, rid: str) -> DataFrame:
    """rid, kind, start, end of all spans: base ones, and terms to generalise or remove."""
    found = stage(mentions(df, text, rid), "mentions")
    reveal = stage(disclosing_terms(df, text, rid, found), "reveal")
    of_row = found.select("rid", "entity").distinct().join(reveal, "entity").groupBy("rid", "term").agg(F.max("ratio").alias("ratio"))
    added = term_places(df.select(col(rid).alias("rid"), text_or_empty(text).alias("t")), stage(of_row, "chosen"))
    added = added.select("rid", F.when(F.col("ratio") >= REMOVE, "remove").otherwise("generalise").alias("kind"), "start", "end")
    return found.select("rid", "kind", "start", "end").union(added)


def _places(kinds: list[str]) -> Column:
    numbers = F.create_map(*[F.lit(x) for k, kind in enumerate(KINDS) for x in (kind, k)])
    rows = F.sort_array(F.collect_list(F.when(F.col("kind").isin(kinds), F.struct(numbers[F.col("kind")].alias("k"), "start", "end", "kind"))))
    return F.array_join(F.transform(rows, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def sanitise(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with every span of ``text`` replaced: base ones by their kind, terms by ``<TERM>`` or nothing.

    Null texts stay null. Of overlapping spans the union is replaced, by the name of the first. ``df``
    must be a file scan (see ``keyed``)."""
    rows, rid = keyed(df)
    # cuts: for each span that does not begin inside the ones before it, the kept text before it and the replacement
    before = Window.partitionBy("rid").orderBy("start", F.col("end").desc(), "kind").rowsBetween(Window.unboundedPreceding, -1)
    found = spans(rows, text, rid).withColumn("upto", F.coalesce(F.max("end").over(before), F.lit(0)).cast("long"))
    cut = F.when(F.col("start") >= F.col("upto"), F.struct(F.col("upto").alias("a"), F.col("start").alias("b"), F.col("kind").alias("k")))
    state = fresh(rows, "_state")
    per_row = found.groupBy(F.col("rid").alias(rid)).agg(F.struct(F.sort_array(F.collect_list(cut)).alias("cuts"), F.max("end").alias("end")).alias(state))
    name = lambda k: F.when(k == "remove", "").when(k == "generalise", "<TERM>").otherwise(F.concat(F.lit("<"), F.upper(k), F.lit(">")))
    t = col(text)
    out = rows.join(per_row, rid, "left")
    pieces = F.transform(col(state)["cuts"], lambda c: F.concat(F.substring(t, (c["a"] + 1).cast("int"), (c["b"] - c["a"]).cast("int")), name(c["k"])))
    new = F.concat(F.array_join(pieces, ""), F.substring(t, (col(state)["end"] + 1).cast("int"), F.length(t)))
    out = out.withColumn(text, F.when(col(state).isNull() | t.isNull(), t).otherwise(new))
    return out.select(*[col(c) for c in df.columns])


def op1_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, rid = keyed(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.sum((F.col("kind") == k).cast("long")).alias(f"n_{k}")
    per_row = spans(docs, "text", rid).groupBy("rid").agg(*[count(k) for k in BASE], _places(BASE).alias("base"), _places(KINDS).alias("spans"))
    rows = docs.select("doc_id", F.col(rid).alias("rid")).join(per_row, "rid", "left")
    return rows.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
