"""Document fingerprints: Merkle trees over sections, paragraphs and sentences.

A document is sections (parted by blank lines or headings), a section is paragraphs (lines),
a paragraph is sentences.  A sentence ends at . ! ? or their full-width forms; one of more than
MOST characters (lists, tables, scripts without stops) is cut into leaves where the hash of the
last WINDOW characters says so, thus at the same places wherever the same words stand: an edit
changes the leaves around it and no others.  Leaves are hashed with their words' bytes, inner
nodes with their children's hashes; the root also takes the whole text, so that equal roots mean equal texts.
The fingerprint string lists the tree, hence two strings are enough to test equality (the
roots) and to find what differs (descend where hashes differ).

String: root '|' sections; a section is its hash ':' paragraphs parted by ';'; a paragraph
is leaves parted by ','; a leaf is eight hex digits and '.' and its length in code points.

Likeness of two trees is the share of their code points that lie in leaves they have in
common (as multisets): 2*common / (all of both), 1 for equal roots.

Defined cases: a null text is an empty one (a root and no section); two empty texts are
alike (1), an empty and another are not (0); rows are ordered by doc_id descending, nulls
last, equal ids by a hash of the text, so that one id may spread over ranges; the only row is
its own next document; a very long text is taken whole (a task holds two documents at a time);
an empty table gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_BYTES = 16 << 20
MOST_BUCKETS = 1 << 16  # so many keys at most are known to all tasks; buckets of larger inputs are larger
OUT_BYTES = 8 << 20
SENTENCE = re.compile(r"[^.!?。！？｡]*[.!?。！？｡]*")
LEAST, MOST, WINDOW = 16, 128, 8  # characters of a cut leaf, and of the hash that cuts
SLICE = 1 << 16  # characters hashed at once
#: A heading begins a section: a markdown or numbered title line.
HEADING = re.compile(r"(?:#{1,6} |\d+(?:\.\d+)*\.? {1,3}[A-Z][^.!?]{0,80}$)")

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _hash(data: bytes) -> str:
    return xxhash.xxh3_64_hexdigest(data)


def marks(text: str) -> np.ndarray:
    """Behind which characters a long sentence may be cut: where the hash of the last WINDOW ones is low, one place in 64."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    found = []
    for start in range(0, len(codes), SLICE):
        x = codes[max(0, start - WINDOW + 1) : start + SLICE].astype(np.uint64)
        h, by = np.zeros(len(x), np.uint64), np.uint64(0x9E3779B97F4A7C15)
        with np.errstate(over="ignore"):
            for k in range(min(WINDOW, len(x))):
                h[k:] += x[: len(x) - k] * by
                by *= np.uint64(0xD6E8FEB86659FD93)
        before = start - max(0, start - WINDOW + 1)
        found.append(np.flatnonzero(h[before:] >> np.uint64(58) == 0) + start + 1)
    return np.concatenate(found) if found else np.empty(0, np.int64)


def pieces(start: int, end: int, at: np.ndarray) -> list[int]:
    """Where the leaves of the sentence text[start:end] end: pieces of LEAST to MOST characters, cut at marks; the last may be shorter."""
    ends, last = [], start
    for mark in [*at[np.searchsorted(at, start + LEAST) : np.searchsorted(at, end)].tolist(), end]:
        while mark - last > MOST:
            last += MOST
            ends.append(last)
        if mark - last >= LEAST:
            last = mark
            ends.append(last)
    if last < end:
        ends.append(end)
    return ends


def _leaf(s: str) -> str:
    return f"{xxhash.xxh32_hexdigest(s.encode('utf-8', 'surrogatepass'))}.{len(s)}"


def tree(text: str | None) -> str:
    """The fingerprint string."""
    text = text or ""
    sections: list[list[str]] = [[]]
    begins, at = 0, None
    for line in text.split("\n"):
        blank = not line.strip()
        if (blank or HEADING.match(line)) and sections[-1]:
            sections.append([])
        if not blank:
            leaves, first = [], begins
            for s in SENTENCE.findall(line):
                if len(s) > MOST:
                    at = marks(text) if at is None else at
                    ends = pieces(first, first + len(s), at)
                    leaves += [_leaf(text[i:j]) for i, j in zip([first, *ends], ends)]
                elif s:
                    leaves.append(_leaf(s))
                first += len(s)
            sections[-1].append(",".join(leaves))
        begins += len(line) + 1
    parts = [f"{_hash(body.encode())}:{body}" for body in (";".join(s) for s in sections if s)]
    whole = hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()[:16]
    inner = "".join(p[:16] for p in parts).encode()
    return "|".join([_hash(inner + whole) + _hash(whole), *parts])


def _leaves(fingerprint: str) -> Counter:
    return Counter(leaf for part in fingerprint.split("|")[1:] for leaf in part[17:].replace(";", ",").split(","))


def _weight(leaves: Counter) -> int:
    return sum(n * int(leaf[9:]) for leaf, n in leaves.items())


def likeness(one: str, two: str) -> float:
    if one.split("|", 1)[0] == two.split("|", 1)[0]:
        return 1.0
    a, b = _leaves(one), _leaves(two)
    every = _weight(a) + _weight(b)
    return 2 * _weight(a & b) / every if every else 0.0


def edits(one: str, two: str) -> list[tuple[int, int, int]]:
    """Where one's tree leaves two's: (section, paragraph, leaf) of one's leaves that two has not.

    Sections whose hash two has are skipped whole, paragraphs likewise; only the rest is
    compared leaf by leaf.
    """
    if one.split("|", 1)[0] == two.split("|", 1)[0]:
        return []
    parts = two.split("|")[1:]
    same, paragraphs, leaves = {p[:16] for p in parts}, {q for p in parts for q in p[17:].split(";")}, _leaves(two)
    return [
        (i, j, k)
        for i, part in enumerate(one.split("|")[1:]) if part[:16] not in same
        for j, body in enumerate(part[17:].split(";")) if body not in paragraphs
        for k, leaf in enumerate(body.split(",")) if leaf not in leaves
    ]


def edited(text: str, other: str) -> str:
    """text with its last third taken from the beginning of other (less if other is shorter)."""
    k = len(text) // 3
    return text[: len(text) - k] + other[:k]


def _walk(batches):
    """Rows in the order of (bucket, document); of each bucket the guest, its last row's next document, comes last."""
    names, kinds = RESULT.replace(",", "").split()[::2], [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    out, held, before = [], 0, None
    for batch in batches:
        for bucket, doc_id, text, guest in zip(*(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "text", "guest"))):
            text = text or ""
            if before is not None and before[0] == bucket:
                _, last_id, last, one = before
                new, after = edited(last, text), tree(text)
                two = tree(new)
                out.append((last_id, len(last), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), one, two, likeness(one, two), likeness(one, after)))
                held += len(one) + len(two)
                before = None if guest else (bucket, doc_id, text, after)
            elif not guest:
                before = (bucket, doc_id, text, tree(text))
            if held > OUT_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
                out, held = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)


def fingerprint(docs: DataFrame) -> DataFrame:
    """docs with a column fingerprint of their texts; columns stay (an own column of that name is replaced)."""
    @F.pandas_udf("string")
    def of(texts):
        return texts.map(tree, na_action=None)

    return docs.withColumn("fingerprint", of(F.coalesce("text", F.lit(""))))


def compare_with_next(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """docs(doc_id, text) -> fingerprints of each text and of its edit with the next document.

    The keys alone are dealt into ranges first; where the ranges begin (one key for each
    bucket_bytes of text, MOST_BUCKETS at most) is known to all tasks.  Then one shuffle puts the documents into
    their ranges, the first of each range into the range before it too, as the next document
    of its last row; a task walks through its sorted rows.
    """
    total = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    n = max(1, min(total[1], -(-(total[0] or 0) // bucket_bytes), MOST_BUCKETS))
    null, falling = F.col("doc_id").isNull(), F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit(0))  # ~x falls as x grows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", null.alias("null"), falling.alias("falling"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"))
    keys = rows.select("null", "falling", "tie").repartitionByRange(n, "null", "falling", "tie")
    heads = keys.groupBy(F.spark_partition_id()).agg(F.min(F.struct("null", "falling", "tie")).alias("h")).select("h.*").collect()  # a key for each bucket
    if not heads:
        return docs.sparkSession.createDataFrame([], RESULT)
    heads = sorted(map(tuple, heads))

    @F.pandas_udf("long")
    def place(null: pd.Series, falling: pd.Series, tie: pd.Series) -> pd.Series:
        """Twice the bucket, and one more for the key that begins it."""
        keys = zip(null.tolist(), falling.tolist(), tie.tolist())
        return pd.Series([2 * (at := bisect_right(heads, k) - 1) + (heads[at] == k) for k in keys], dtype="int64")

    at = F.col("place").bitwiseAND(1)
    bucket = F.shiftright("place", 1).cast("int")
    own, guest = F.struct(bucket.alias("bucket"), F.lit(False).alias("guest")), F.struct(F.pmod(bucket - 1, F.lit(len(heads))).alias("bucket"), F.lit(True).alias("guest"))
    return (
        rows.withColumn("place", place("null", "falling", "tie"))
        .select("doc_id", "text", "null", "falling", "tie", F.inline(F.when(at == 1, F.array(own, guest)).otherwise(F.array(own))))
        .repartition(len(heads), "bucket").sortWithinPartitions("bucket", "guest", "null", "falling", "tie")
        .select("bucket", "doc_id", "text", "guest").mapInArrow(_walk, RESULT)
    )
