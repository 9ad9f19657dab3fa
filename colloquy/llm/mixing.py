"""Mixing sources to target weights by iterative proportional fitting, DataFrame functions only.

Documents' tokens are summed in cells of source, language and topic.  Raking scales the
cells until their sums match the target shares of each source, each language and each
topic; the fitted cell over the cell's tokens is its weight.  A document is sampled with the
probability weight / largest weight * rate, by a hash of its id, so that a cell's expected
tokens follow the fit and every rerun samples the same documents.

The raking works on the cell table (sources x languages x topics rows, whatever the number
of documents); one shuffle sums the documents into it, with partial sums before.  It goes on
until every margin is within TOLERANCE of its target, or no longer gets nearer, as with
targets that contradict one another.

Targets: a mapping of value to share for any of the three margins.  A margin without one
takes shares in proportion to tokens ** TEMPER, which lifts small sources.  Values of the
corpus that a given mapping does not name get the share 0 and are not sampled; a mapping that
names none of them, or only shares of 0, samples nothing.

Defined cases: null source, language or topic is a value of its own (""); a null or empty
text has no tokens and is not sampled, so that a corpus of empty texts gives no sample; a text
is counted whole, however long; rows of one doc_id are sampled together; a null doc_id hashes
as ""; an empty table gives no rows; mix() keeps all columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.common import materialize

MARGINS = ("source", "lang", "topic")
TEMPER = 0.9
ROUNDS = 8  # between two looks at the margins
LOOKS = 25  # at the most
TOLERANCE = 1e-6  # of all tokens
RATE = 1.0
WORD = "[^\\x20\\x09-\\x0D]+"
#: Rows of the cell table (some 100 bytes each) that may be broadcast, or raked in one partition without exchanges; more
#: are joined and raked by shuffles, with the same result.
FEW_CELLS = 50_000
DIGITS = 13  # hex digits of the hash that make the uniform number


def topic_of(text: Column) -> Column:
    """A coarse topic from the form of the whole text: what holds more than a share of it."""
    n = F.length(text)
    marks = lambda of: F.regexp_count(text, F.lit(f"[{of}]"))
    return (
        F.when(n == 0, "empty")
        .when(marks("|%&#$*!") * 20 > n, "marked")
        .when(marks("0123456789@=") * 50 > n, "data")
        .when(marks("\n") * 200 > n, "lines")
        .otherwise("prose")
    )


def _tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _uniform(doc_id: Column, seed: int) -> Column:
    key = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")))
    return F.conv(F.substring(key, 1, DIGITS), 16, 10).cast("double") / float(16**DIGITS)


def _target(cells: DataFrame, margin: str, shares: dict | None, temper: float) -> DataFrame:
    """(margin, target): tokens wanted, adding up to the corpus's tokens."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("t"))
    if shares is None:
        sums = sums.withColumn("share", F.when(F.col("t") > 0, F.pow(F.col("t").cast("double"), temper)).otherwise(0.0))
    else:
        flat = [x for k, v in shares.items() for x in (F.lit(k), F.lit(float(v)))]
        known = F.create_map(*flat) if flat else F.create_map().cast("map<string,double>")
        sums = sums.withColumn("share", F.when(F.col("t") > 0, F.coalesce(F.try_element_at(known, F.col(margin)), F.lit(0.0))).otherwise(0.0))
    every = sums.agg(F.nullif(F.sum("share"), F.lit(0.0)).alias("shares"), F.sum("t").alias("all"))  # one row
    return sums.crossJoin(F.broadcast(every)).select(margin, F.coalesce(F.col("share") / F.col("shares") * F.col("all"), F.lit(0.0)).alias(f"t_{margin}"))


def _rounds(fitted: DataFrame, rounds: int) -> DataFrame:
    """fitted(margins, their targets, fit) after so many rounds over the margins."""
    for _ in range(rounds):
        for m in MARGINS:
            now = F.sum("fit").over(Window.partitionBy(m))
            fitted = fitted.withColumn("fit", F.when(now > 0, F.col("fit") * F.col(f"t_{m}") / now).otherwise(0.0))
    return fitted


def residual(fitted: DataFrame) -> float:
    """The largest distance of a margin's sum from its target, as a share of all tokens; 0 for no tokens."""
    off = [fitted.groupBy(m).agg(F.abs(F.sum("fit") - F.first(f"t_{m}")).alias("off"), F.sum("tokens").alias("t")) for m in MARGINS]
    got = off[0].unionByName(off[1].drop("lang"), True).unionByName(off[2].drop("topic"), True).agg(F.max("off").alias("off"), F.sum("t").alias("t")).first()
    return len(MARGINS) * got["off"] / got["t"] if got["t"] else 0.0


def rake(cells: DataFrame, targets: dict | None = None, temper: float = TEMPER, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """cells(source, lang, topic, tokens) -> with weight: fitted tokens over tokens, 0 where it has none."""
    targets, few = targets or {}, cells.count() <= FEW_CELLS
    fitted, before = cells, float("inf")
    for m in MARGINS:
        fitted = fitted.join(_target(cells, m, targets.get(m), temper), m)
    fitted = fitted.withColumn("fit", F.col("tokens").cast("double"))
    for _ in range(LOOKS):
        fitted = materialize(_rounds(fitted.coalesce(1) if few else fitted, rounds))
        now = residual(fitted)
        if now <= tolerance or now > 0.99 * before:
            break
        before = now
    return fitted.select(*MARGINS, "tokens", F.when(F.col("tokens") > 0, F.col("fit") / F.col("tokens")).otherwise(0.0).alias("weight"))


def features(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens of docs(doc_id, text, source, lang)."""
    text = F.coalesce("text", F.lit(""))
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select("doc_id", none("source").alias("source"), none("lang").alias("lang"), topic_of(text).alias("topic"), _tokens(text).alias("n_tokens"))


def weights(found: DataFrame, targets: dict | None = None, temper: float = TEMPER, rounds: int = ROUNDS, rate: float = RATE) -> DataFrame:
    """features -> (source, lang, topic, weight, probability)."""
    cells = materialize(found.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")))
    raked = rake(cells, targets, temper, rounds)
    most = raked.agg(F.max("weight").alias("most"))
    share = F.when(F.col("most") > 0, F.least(F.lit(1.0), F.col("weight") / F.col("most") * rate)).otherwise(0.0)
    return raked.crossJoin(F.broadcast(most)).select(*MARGINS, "weight", share.alias("probability"))  # most: one row


def _with_weights(rows: DataFrame, table: DataFrame) -> DataFrame:
    table = materialize(table)
    return rows.join(F.broadcast(table) if table.count() <= FEW_CELLS else table, list(MARGINS))


def sampled(docs: DataFrame, seed: int = 0, **how) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, weight, probability, sampled for every row of docs."""
    found = materialize(features(docs))
    out = _with_weights(found, weights(found, **how))
    return out.select(
        "doc_id", *MARGINS, "n_tokens", F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"),
        (_uniform(F.col("doc_id"), seed) < F.col("probability")).alias("sampled"),
    )


def mix(docs: DataFrame, seed: int = 0, **how) -> DataFrame:
    """The sampled rows of docs with all their columns."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text", "source", "lang")
    text = F.coalesce("text", F.lit(""))
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = whole.select("row", "doc_id", none("source").alias("source"), none("lang").alias("lang"), topic_of(text).alias("topic"))
    out = _with_weights(rows, weights(features(docs), **how)).where(_uniform(F.col("doc_id"), seed) < F.col("probability"))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def sql(rounds: int = ROUNDS, temper: float = TEMPER, rate: float = RATE, seed: int = 0) -> str:
    """sampled() over documents as DuckDB SQL, for a fit that is near enough after one look: the rounds are written out as
    nested window sums."""
    fit = "cells"
    margins = ", ".join(
        f"(select {m}, case when sum(tokens) > 0 then pow(sum(tokens)::double, {temper}) else 0.0 end as s_{m} from cells group by 1) x_{m}" for m in MARGINS)
    wanted = f"""(select c.source, c.lang, c.topic, c.tokens, c.tokens::double as fit, {", ".join(
        f"s_{m} / (select nullif(sum(s), 0) from (select case when sum(tokens) > 0 then pow(sum(tokens)::double, {temper}) else 0.0 end as s from cells group by {m})) * (select sum(tokens) from cells) as t_{m}" for m in MARGINS)}
      from cells c, {margins} where {" and ".join(f"c.{m} = x_{m}.{m}" for m in MARGINS)})"""
    fit = wanted
    for _ in range(rounds):
        for m in MARGINS:
            fit = f"(select source, lang, topic, tokens, t_source, t_lang, t_topic, case when sum(fit) over (partition by {m}) > 0 then fit * t_{m} / sum(fit) over (partition by {m}) else 0.0 end as fit from {fit})"
    share = lambda marks: f"(n - length(translate(txt, '{marks}', '')))"
    return f"""with txt as (select doc_id, coalesce(source, '') as source, coalesce(lang, '') as lang, coalesce(text, '') as txt, length(coalesce(text, '')) as n from documents),
    found as (select doc_id, source, lang, case when n = 0 then 'empty' when {share("|%&#$*!")} * 20 > n then 'marked'
      when {share("0123456789@=")} * 50 > n then 'data' when (n - length(replace(txt, chr(10), ''))) * 200 > n then 'lines' else 'prose' end as topic,
      len(regexp_extract_all(txt, '[^\x20\x09-\x0D]+'))::bigint as n_tokens from txt),
    cells as (select source, lang, topic, sum(n_tokens)::bigint as tokens from found group by all),
    raked as (select source, lang, topic, case when tokens > 0 then fit / tokens else 0.0 end as weight from {fit}),
    shares as (select *, case when max(weight) over () > 0 then least(1.0, weight / max(weight) over () * {rate}) else 0.0 end as p from raked)
    select f.doc_id, f.source, f.lang, f.topic, f.n_tokens, round(s.weight, 6) as weight, round(s.p, 6) as probability,
      (('0x' || substr(md5(f.doc_id::varchar || ':{seed}'), 1, {DIGITS}))::bigint / {float(16**DIGITS)!r}) < s.p as sampled
    from found f join shares s on f.source = s.source and f.lang = s.lang and f.topic = s.topic"""
