"""Secret scans with DataFrame functions only.

Base kinds are three fixed patterns.  The method adds spans of kind "entropy": candidate
strings are maximal runs of credential characters; for each character class a window slides
over the candidate, its Shannon entropy is kept by incremental counts (one character leaves,
one enters), and the hot windows, merged, are a span unless the allow list knows all the long
pieces (between "/", "=", "_" and "-") that they lie in.

Defined cases: a null or empty text has no spans; a very long text is scanned whole; extra columns are kept by redact() and
ignored by scan(); repeated rows are scanned one by one; ties cannot arise (spans are ordered
by start, then kind).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the base kinds, in the order in which they are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # 18 characters or more; a shorter run holds no longer match
HEX = r"[0-9a-f]{16,}"  # maximal, as the first character of a run starts the match
ASSIGN_LEAST = 12

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: (kind of candidate, which strings are of the class, bits a window needs)
CLASSES = (
    ("hex", r"^[0-9a-fA-F]+$", 2.7),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_=-]+$", 3.6),
    ("lower", r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9+/_=-]+$", 3.4),
    ("upper", r"^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9+/_=-]+$", 3.4),
)
#: Strings of two kinds of characters are words with a number as well (paths, slugs, part numbers), so their hot windows
#: count only with an unbroken piece of this form: 16 characters, and digits in two places at least.
UNBROKEN = r"(?=[A-Za-z0-9]{16})[A-Za-z]*[0-9]+[A-Za-z]+[0-9]"
UUID = r"(?i)(?<![0-9a-f])[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}(?![0-9a-f])"
#: An integrity digest reaches over "/", so its end is looked for from the run's start.
DIGEST = r"^sha(?:1|256|512)-[A-Za-z0-9+/]{1,86}={0,2}"
#: Strings that look random and are known not to be secrets: sample keys, counting sequences, UUIDs,
#: integrity digests that name their algorithm.
ALLOW = (
    r"(?i)(example|sample|placeholder|dummy|changeme|x{8}|0123456789|abcdefghij|(?<![0-9a-f])[0-9a-f]{8}-[0-9a-f]{4}-"
    r"[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}(?![0-9a-f])|^sha(1|256|512)-)"
)
KINDS = ("assign", "access", "hex", "entropy")
RUN = 128  # matches whose places are summed in one fold


def _let(value: Column, body) -> Column:
    """body(value) with value computed once: lambda variables are the only names there are."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _xlogx(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def _spans(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """array<struct<start,kind,end,m>> of the matches, in code points.

    split() gives the gaps between the matches that regexp_extract_all() gives, so running
    sums of their lengths are the positions.  A fold copies the array that it grows, so the
    sums run within runs of RUN matches, and over the runs.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    parts = F.arrays_zip(found, F.slice(gaps, 1, F.greatest(F.size(found), F.lit(1)))).cast("array<struct<m:string,g:string>>")
    item = "struct<start:int,kind:int,end:int,m:string>"
    length = lambda p: F.length(p["g"]) + F.length(p["m"])

    def placed(run: Column, at: Column) -> Column:
        return F.aggregate(
            run,
            F.struct(at.alias("at"), F.array().cast(f"array<{item}>").alias("out")),
            lambda a, p: F.struct(
                (a["at"] + length(p)).alias("at"),
                F.concat(
                    a["out"],
                    F.array(F.struct(
                        (a["at"] + F.length(p["g"])).alias("start"), F.lit(kind).alias("kind"), (a["at"] + length(p)).alias("end"), p["m"].alias("m"),
                    ).cast(item)),
                ).alias("out"),
            ),
            lambda a: a["out"],
        )

    def in_runs(p: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / RUN).cast("int")), lambda k: F.slice(p, k * RUN + 1, F.lit(RUN)))
        # where each run begins: the sums of the runs before it
        begins = F.aggregate(runs, F.array(F.lit(0)), lambda a, r: F.concat(a, F.array(F.element_at(a, -1) + F.aggregate(r, F.lit(0), lambda n, x: n + length(x)))))
        return _let(begins, lambda b: F.flatten(F.transform(runs, lambda r, i: placed(r, F.get(b, i)))))

    out = _let(parts, lambda p: F.when(F.size(p) > RUN, in_runs(p)).otherwise(placed(p, F.lit(0))))
    out = F.filter(out, keep) if keep else out
    return F.when(F.size(found) > 0, out).otherwise(F.array().cast(f"array<{item}>"))


def _hot_windows(s: Column, bits: float) -> Column:
    """array<struct<s,e>> of the merged windows of s whose entropy reaches bits.

    The state holds the counts of the window's characters in a map and the sum of c*log2(c),
    changed by one character at a time; entropy is log2(W) - sum/W.
    """
    w, spans = WINDOW, "array<struct<s:int,e:int>>"
    counts = "struct<n:map<string,int>,sum:double>"

    def bump(a: Column, ch: Column, by: int) -> Column:
        return _let(F.coalesce(F.try_element_at(a["n"], ch), F.lit(0)), lambda c: F.struct(
            F.map_concat(F.map_filter(a["n"], lambda k, _: k != ch), F.create_map(ch, (c + by).cast("int"))).alias("n"),
            (a["sum"] - _xlogx(c) + _xlogx(c + by)).alias("sum"),
        ).cast(counts))

    def merge(out: Column, i: Column) -> Column:
        last = F.try_element_at(out, F.lit(-1))
        return F.when(
            F.coalesce(last["e"], F.lit(-1)) >= i - w,
            F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(F.struct(last["s"].alias("s"), i.alias("e")))),
        ).otherwise(F.concat(out, F.array(F.struct((i - w).alias("s"), i.alias("e")))))

    def fold(chars: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            grown = bump(a["c"], F.element_at(chars, i), 1)
            moved = F.when(i > w, _let(grown, lambda g: bump(g, F.element_at(chars, F.greatest(i - w, F.lit(1))), -1))).otherwise(grown)
            return _let(moved, lambda c: F.struct(
                c.alias("c"),
                F.when((i >= w) & (F.lit(math.log2(w)) - c["sum"] / w >= bits), merge(a["out"], i)).otherwise(a["out"]).cast(spans).alias("out"),
            ))

        empty = F.struct(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>")).alias("n"), F.lit(0.0).alias("sum"))
        zero = F.struct(empty.cast(counts).alias("c"), F.array().cast(spans).alias("out"))
        return F.aggregate(F.sequence(F.lit(1), F.size(chars)), zero, step, lambda a: a["out"])

    return _let(F.split(s, ""), fold)


def _entropy(candidates: Column) -> Column:
    item = "struct<start:int,kind:int,end:int,m:string>"

    def known(m: Column, h: Column) -> Column:
        """Whether the allow list knows every long piece of the hot window h, with the rest of the segments at its ends, or
        a digest covers it.  A word beside a long piece does not make it known."""
        before = F.regexp_extract(F.substring(m, F.lit(1), h["s"]), "[^/=]*$", 0)
        after = F.regexp_extract(F.substring(m, h["e"] + 1, F.length(m)), "^[^/=]*", 0)
        segment = F.concat(before, F.substring(m, h["s"] + 1, h["e"] - h["s"]), after)
        pieces = F.split(F.regexp_replace(segment, UUID, "="), "[/=_-]+")
        return ~F.exists(pieces, lambda x: (F.length(x) >= 16) & ~x.rlike(ALLOW)) | (h["e"] <= F.length(F.regexp_extract(m, DIGEST, 0)))

    def of(c: Column) -> Column:
        hot = F.array().cast("array<struct<s:int,e:int>>")
        within = lambda h: F.substring(c["m"], h["s"] + 1, h["e"] - h["s"])
        for kind, shape, bits in reversed(CLASSES):
            found = _hot_windows(c["m"], bits)
            if kind in ("lower", "upper"):
                found = F.filter(found, lambda h: within(h).rlike(UNBROKEN))
            hot = F.when(c["m"].rlike(shape), found).otherwise(hot)
        hot = F.when(c["m"].rlike(ALLOW), F.filter(hot, lambda h: ~known(c["m"], h))).otherwise(hot)
        return F.transform(hot, lambda h: F.struct(
            (c["start"] + h["s"]).alias("start"), F.lit(3).alias("kind"), (c["start"] + h["e"]).alias("end"), F.lit("").alias("m"),
        ).cast(item))

    return F.when(F.size(candidates) > 0, F.flatten(F.transform(candidates, of))).otherwise(F.array().cast(f"array<{item}>"))


def scan(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """docs with text -> keep columns, and base, added: arrays of (start, kind, end), sorted.

    kind is an index of KINDS.  added are entropy spans that no base span covers.
    """
    keep = keep if keep is not None else ["doc_id"]
    text = F.coalesce(F.col("text"), F.lit(""))
    long_enough = lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= ASSIGN_LEAST
    found = docs.select(
        *keep,
        _spans(text, ASSIGN, 0, long_enough).alias("_assign"), _spans(text, ACCESS, 1).alias("_access"),
        _spans(text, HEX, 2).alias("_hex"), _spans(text, CANDIDATE, 3).alias("_cand"),
    )
    bare = lambda c: F.transform(c, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    base = F.array_sort(bare(F.concat("_assign", "_access", "_hex")))
    some = F.size("_cand") > 0
    base_col, added = F.col("_base"), F.col("_added")
    return (
        found.withColumn("_base", base)
        .withColumn("_added", F.when(some, bare(_entropy(F.col("_cand")))).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>")))
        .select(
            *keep, base_col.alias("base"),
            F.filter(added, lambda x: ~F.exists(base_col, lambda b: (b["start"] <= x["start"]) & (b["end"] >= x["end"]))).alias("added"),
        )
    )


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat(
        F.element_at(names, x["kind"] + 1), F.lit(":"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string"))))


def digest(docs: DataFrame) -> DataFrame:
    """One row for each document: counts of the base kinds, a hash of the base spans, all spans."""
    n = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return scan(docs).select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_entropy"),
    )


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """docs with every span of its text replaced by mask, n_chars set to the new length if there is
    one; other columns stay.  Overlapping spans become one mask.  A null text stays null.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    text, some = F.col("text"), F.size("spans") > 0
    out = F.aggregate(
        F.col("spans"),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda a, x: F.struct(
            F.greatest(a["at"], x["end"]).alias("at"),
            F.when(x["start"] >= a["at"], F.concat(a["out"], F.array(F.substring(text, a["at"] + 1, x["start"] - a["at"]), F.lit(mask))))
            .otherwise(a["out"]).alias("out"),
        ),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text))),
    )
    marked = (
        scan(whole, ["row", "text"])
        .select("row", "text", F.array_sort(F.concat("base", "added")).alias("spans"))
        .withColumn("clean", F.when(some, out).otherwise(text))
    )
    new = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(some, F.length("clean").cast(kind)).otherwise(F.col("row.n_chars"))
    return marked.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def sql() -> str:
    """digest() over documents as DuckDB SQL.  Its regular expressions have no lookaround, so the allow list and the
    mixed class are spelled without; entropy is taken of every window anew."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    kinds = ((0, ASSIGN), (1, ACCESS), (2, HEX), (3, CANDIDATE))
    found = " union all ".join(
        f"select doc_id, {k} as kind, unnest(regexp_extract_all(txt, {q(p)})) as m, unnest(string_split_regex(txt, {q(p)})[1:len(regexp_extract_all(txt, {q(p)}))]) as g, "
        f"unnest(range(len(regexp_extract_all(txt, {q(p)})))) as i from txt" for k, p in kinds)
    uuid = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
    allow = f"(?i)(example|sample|placeholder|dummy|changeme|x{{8}}|0123456789|abcdefghij|(^|[^0-9a-f]){uuid}($|[^0-9a-f])|^sha(1|256|512)-)"
    mixed = " and ".join(f"regexp_matches(m, {q(x)})" for x in ("^[A-Za-z0-9+/_=-]+$", "[0-9]", "[a-z]", "[A-Z]"))
    bits = f"case when regexp_matches(m, {q(allow)}) then null when regexp_matches(m, '^[0-9a-fA-F]+$') then {CLASSES[0][2]} when {mixed} then {CLASSES[1][2]} end"
    listed = lambda k: f"concat(case {k} {' '.join(f'when {i} then {q(n)}' for i, n in enumerate(KINDS))} end, ':', s, ':', e)"
    return f"""with txt as (select doc_id, coalesce(text, '') as txt from documents), found as ({found}),
    placed as (select doc_id, kind, m, (sum(length(g) + length(m)) over (partition by doc_id, kind order by i) - length(m))::bigint as s from found),
    spans as (select doc_id, kind, s, s + length(m) as e from placed where kind in (1, 2) or (kind = 0 and length(regexp_extract(m, {q(ASSIGN)}, 2)) >= {ASSIGN_LEAST})),
    cand as (select doc_id, s, m, {bits} as bits from placed where kind = 3),
    hot as (select doc_id, s, w from (select doc_id, s, bits, m, unnest(range(length(m) - {WINDOW - 1})) as w from cand where bits is not null)
      where list_aggregate(string_split(substr(m, (w + 1)::bigint, {WINDOW}), ''), 'entropy') >= bits),
    isle as (select *, sum(case when w - prev <= {WINDOW} then 0 else 1 end) over (partition by doc_id, s order by w) as n from (select *, lag(w) over (partition by doc_id, s order by w) as prev from hot)),
    added as (select doc_id, 3 as kind, s + min(w) as s, s + max(w) + {WINDOW} as e from isle group by doc_id, isle.s, n),
    fresh as (select * from added a where not exists (select 1 from spans b where b.doc_id = a.doc_id and b.s <= a.s and b.e >= a.e)),
    base as (select doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex, string_agg({listed('kind')}, ',' order by s, kind) as l from spans group by doc_id),
    every as (select doc_id, string_agg({listed('kind')}, ',' order by s, kind) as l, count(*) filter (kind = 3) as n from (select * from spans union all select * from fresh) group by doc_id)
    select t.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(b.l, '')) as base_sha256, coalesce(x.l, '') as spans, coalesce(x.n, 0) as n_entropy
    from txt t left join base b on t.doc_id = b.doc_id left join every x on t.doc_id = x.doc_id"""
