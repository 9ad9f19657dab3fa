"""N-gram Jaccard join: MinHash LSH forest, then exact verification.

A document is the set of its five-word shingles.  Documents of one set are one member; only
members are compared.  A member's signature is TREES label sequences of DEEPEST MinHash
labels.  For each tree the sequences are a prefix trie: members are brought together by the
shortest prefix that is ever used, and sorted by their labels, so that the members sharing a
longer prefix are neighbours.  Of every pair that meets, at the first of its trees, the
signatures give the similarity and the longest prefix shared in any tree.

Matching begins at the deepest prefix, and the prefix is shortened until the links found
reach the target recall: that share of the pairs whose signatures do not rule a link out,
counted over all data at every depth.  The shortest prefix is the one at which a pair
just similar enough is expected to meet with that recall, so the loop ends there at the
latest.

Pairs that meet at the depth found and whose signatures do not rule a link out (by five
standard deviations) join members to groups (components); within a group all pairs are compared
exactly, by their shingles, so links that the forest itself missed within a group are found
too.  A weak meeting of two unlike documents makes no group.

Words are runs of bytes other than 0x20 and 0x09-0x0D, unchanged.  A text of one to four
words is one shingle; a text without words, or null, has none, and is a class and component
of its own.  A text is taken whole, however long: its shingles are hashed at once and its
signature is built in slices.  Links count rows, copies included.  Each row gives a row,
repeated ones too; rows of one doc_id with different texts are members of their own and have
their own links and classes.  Rows with a null doc_id are left out of join(), as a pair cannot
name them, and kept by keep_first().  Empty tables give no rows; columns other than doc_id
and text are ignored by join() and kept by keep_first(), whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm import common as C
from colloquy.llm import pairs

WORDS = 5
SIMILARITY = 0.8
TREES, DEEPEST = 24, 8
RECALL = 0.9999
TILE = 512
SLOT_ROWS = 3_000  # signatures in a task's comparison
SLOT_SETS = 500  # shingle sets in a task's comparison
CHUNK = 1 << 13  # pairs of signatures compared at once
COLUMNS = 1 << 12  # shingles compared at once in a tile

SKETCH = "doc_id long, text_key long, set_hi long, set_lo long, labels binary"
MET = "a long, b long, depth int, n long"
LINKS = "uid long, root long, links long"


def depth_for(similarity: float, recall: float = RECALL, trees: int = TREES, deepest: int = DEEPEST) -> int:
    """The longest prefix at which a pair of this similarity is expected to meet in some tree often enough."""
    for d in range(deepest, 1, -1):
        if 1 - (1 - similarity**d) ** trees >= recall:
            return d
    return 1


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").split()
    if not tokens:
        return np.empty(0, C.U64)
    h = C.hash_words(tokens)
    if len(h) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(tokens))], C.U64)
    out = h[: len(h) - words + 1]
    for k in range(1, words):
        out = C.mix(out, h[k : len(h) - words + 1 + k])
    return np.unique(out)


def _parameters() -> tuple[np.ndarray, np.ndarray]:
    rnd = np.random.default_rng(20)
    n = TREES * DEEPEST
    return rnd.integers(1, 2**32, n, dtype=np.uint32) | np.uint32(1), rnd.integers(0, 2**32, n, dtype=np.uint32)


def signature(sets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The labels, one byte each, tree by tree: a byte of each MinHash of the shingles."""
    x = (C.mix(sets, 3) >> C.U64(32)).astype(np.uint32)
    low = np.full(len(a), np.iinfo(np.uint32).max, np.uint32)
    with np.errstate(over="ignore"):
        for s in range(0, len(x), 256):
            np.minimum(low, (x[s : s + 256, None] * a + b).min(0), out=low)
        low *= np.uint32(0x9E3779B1)
    return (low >> np.uint32(24)).astype(np.uint8)


def _set_hash(sets: np.ndarray) -> tuple[int, int]:
    two = xxhash.xxh3_128_digest(sets.tobytes())
    return int.from_bytes(two[:8], "little", signed=True), int.from_bytes(two[8:], "little", signed=True)


def _sketch(words: int):
    def run(batches):
        a, b = _parameters()
        for batch in batches:
            hi, lo, labels = [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, words)
                x, y = _set_hash(s)
                hi.append(x)
                lo.append(y)
                labels.append(signature(s, a, b).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(labels, pa.binary())],
                ["doc_id", "text_key", "set_hi", "set_lo", "labels"])

    return run


def _met(similarity: float, shortest: int):
    """Of a slot's trie nodes: forests of the pairs that may be links, by the prefix they share, and how many there are."""
    n_labels = TREES * DEEPEST
    unlike = similarity - 5 * math.sqrt(similarity * (1 - similarity) / n_labels)
    depths = range(DEEPEST, shortest - 1, -1)

    def met(key, table):
        node, uid, tree, mine, ga, gb = (table.column(c).to_numpy().astype(np.int64) for c in ("node", "uid", "tree", "mine", "ga", "gb"))
        labels = np.stack([np.frombuffer(x, np.uint8) for x in table.column("labels").to_pylist()])
        sequence = labels.reshape(-1, TREES, DEEPEST)[np.arange(len(tree)), tree]
        c = pairs.Comparisons([node], ga, gb, mine, np.ascontiguousarray(sequence).view(">u8").ravel())  # sorted by the tree's labels
        uid, tree, labels = uid[c.order], tree[c.order], labels[c.order]
        found: dict[int, list] = {d: [] for d in depths}
        count = dict.fromkeys(depths, 0)
        for a, b in c.pairs(np.arange(len(c.starts)), CHUNK):
            same = (labels[a] == labels[b]).reshape(-1, TREES, DEEPEST)
            agree = same.reshape(len(a), -1).sum(1)
            near = np.flatnonzero(agree >= unlike * n_labels)
            prefix = np.minimum.accumulate(same[near], 2).sum(2)
            own = (prefix >= shortest).argmax(1) == tree[a[near]]  # a pair counts at the first tree in which it meets
            near, depth = near[own], prefix[own].max(1)
            for d in depths:
                at = near[depth == d]
                found[d].append((a[at], b[at]))
                count[d] += len(at)
        names, of = np.unique(uid, return_inverse=True)
        root, out = np.arange(len(names)), []
        x, y = np.empty(0, np.int64), np.empty(0, np.int64)
        for d in depths:
            x = np.concatenate([x, *(of[p] for p, _ in found[d])])
            y = np.concatenate([y, *(of[q] for _, q in found[d])])
            was, root = root, pairs.forest(len(names), x, y)
            moved = np.flatnonzero(root != was)
            out.append(pa.table({"a": names[moved], "b": names[root[moved]], "depth": pa.array([d] * len(moved), pa.int32()), "n": pa.array([0] * len(moved), pa.int64())}))
        none = pa.array([None] * len(count), pa.int64())
        out.append(pa.table({"a": none, "b": none, "depth": pa.array(count, pa.int32()), "n": pa.array(count.values(), pa.int64())}))
        return pa.concat_tables(out)

    return met


def shorten(found: dict[int, int], recall: float, shortest: int, deepest: int = DEEPEST) -> int:
    """The longest prefix at which the share of the candidates found, of all that met, reaches the recall."""
    every, so_far = sum(found.values()), 0
    for d in range(deepest, shortest, -1):
        so_far += found.get(d, 0)
        if so_far >= recall * every:
            return d
    return shortest


def _packed(words: int):
    """The shingles of members; of several texts under a doc_id only the member's own."""

    def run(batches):
        for batch in batches:
            sets = [shingles(t, words) for t in batch.column("text").to_pylist()]
            want = zip(batch.column("set_hi").to_pylist(), batch.column("set_lo").to_pylist())
            own = pa.array([_set_hash(x) == w for x, w in zip(sets, want)], pa.bool_())
            names = ["uid", "grp", "size", "n_docs"]
            out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array([x.tobytes() for x in sets], pa.binary())], [*names, "shingles"])
            yield out.filter(own)

    return run


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of left with every one of right."""
    flat = [np.concatenate(s) for s in (left, right)]
    row = [np.repeat(np.arange(len(s)), list(map(len, s))) for s in (left, right)]
    both = np.intersect1d(*flat)
    out = np.zeros((len(left), len(right)), np.float32)
    at = [np.searchsorted(both, f) for f in flat]
    for k in (0, 1):
        hit = at[k] < len(both)
        hit[hit] = both[at[k][hit]] == flat[k][hit]
        at[k], row[k] = at[k][hit], row[k][hit]
        order = np.argsort(at[k], kind="stable")
        at[k], row[k] = at[k][order], row[k][order]
    for s in range(0, len(both), COLUMNS):
        m = []
        for k, n in ((0, len(left)), (1, len(right))):
            i, j = np.searchsorted(at[k], (s, s + COLUMNS))
            x = np.zeros((n, min(COLUMNS, len(both) - s)), np.float32)
            x[row[k][i:j], at[k][i:j] - s] = 1
            m.append(x)
        out += m[0] @ m[1].T
    return out


def _verify(similarity: float):
    def verify(key, table):
        grp, uid, mine, ga, gb, n_docs = (table.column(c).to_numpy().astype(np.int64) for c in ("grp", "uid", "mine", "ga", "gb", "n_docs"))
        first = np.unique(np.stack([grp, ga, gb, uid]), axis=1, return_index=True)[1]  # a repeated row is the same member
        grp, uid, mine, ga, gb, n_docs = (x[first] for x in (grp, uid, mine, ga, gb, n_docs))
        c = pairs.Comparisons([grp], ga, gb, mine, uid)
        uid, n_docs = uid[c.order], n_docs[c.order].astype(np.float64)
        data = table.column("shingles")
        sets = [np.frombuffer(data[int(k)].as_py(), C.U64) for k in first[c.order]]
        size = np.array(list(map(len, sets)), np.float64)
        links = np.zeros(len(uid))
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for s, m, e, same in zip(c.starts, c.middle, c.ends, c.same):
            i, j = (slice(s, e), slice(s, e)) if same else (slice(s, m), slice(m, e))
            if e - s < 2 or i.start == i.stop or j.start == j.stop:
                continue
            common = overlaps(sets[i], sets[j]).astype(np.float64)
            union = size[i][:, None] + size[j][None, :] - common
            linked = common >= similarity * union - 1e-9 * union
            if same:
                np.fill_diagonal(linked, False)
            else:
                links[j] += linked.T @ n_docs[i]
            links[i] += linked @ n_docs[j]
            x, y = np.nonzero(linked)
            left.append(x + i.start)
            right.append(y + j.start)
        names, of = np.unique(uid, return_inverse=True)
        root = names[pairs.forest(len(names), of[np.concatenate(left)], of[np.concatenate(right)])]
        sums = np.bincount(of, links, len(names)).astype(np.int64)
        some = sums > 0
        return pa.table({"uid": names[some], "root": root[some], "links": sums[some]})

    return verify


def groups(same: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, tile: int = TILE) -> DataFrame:
    """same(uid, labels) -> (id, component): members that may be linked, by the forest."""
    shortest = depth_for(similarity, recall)
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    nodes = same.select("uid", "labels", tree).select(
        "uid", F.col("tree").cast("int"), F.xxhash64("tree", F.substring("labels", F.col("tree") * DEEPEST + 1, F.lit(shortest))).alias("node"))
    counted = C.materialize(nodes.groupBy("node").agg(F.count("*").alias("size")).where("size > 1"))
    rows = counted.agg(F.sum(F.col("size") * pairs.tiles(F.col("size"), tile))).first()[0] or 0
    met = nodes.join(counted, "node").join(same.select("uid", "labels"), "uid")
    dealt = pairs.deal(met, tile, -(-rows // SLOT_ROWS) or 1, ("node",)).select("slot", "node", "tree", "uid", "mine", "ga", "gb", "labels")
    found = C.materialize(dealt.groupBy("slot").applyInArrow(_met(similarity, shortest), MET))
    C.release(same.sparkSession)
    count = {r.depth: r.n for r in found.where("a is null").groupBy("depth").agg(F.sum("n").alias("n")).collect()}  # a row for each depth
    depth = shorten(count, recall, shortest)
    return C.connected_components(found.where((F.col("a").isNotNull()) & (F.col("depth") >= depth)).select("a", "b"))


def _classified(docs: DataFrame, similarity: float, words: int, recall: float, tile: int) -> tuple[DataFrame, DataFrame]:
    """(a row for each of docs: doc_id, text_key, set_hi, set_lo; the members: uid, set_hi, set_lo, rep, n_docs, links, class).

    class is the smallest uid reachable by links, null for a member without links.
    """
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    sketch = C.materialize(texts.mapInArrow(_sketch(words), SKETCH))
    ids = sketch.select("doc_id", "text_key", "set_hi", "set_lo")
    same = C.materialize(
        sketch.where("labels is not null").groupBy("set_hi", "set_lo").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_docs"), F.first("labels").alias("labels"))
        .withColumn("uid", F.monotonically_increasing_id()))
    members = groups(same, similarity, recall, tile).select(F.col("id").alias("uid"), F.col("component").alias("grp"))
    sizes = C.materialize(members.groupBy("grp").agg(F.count("*").alias("size")))
    rows = sizes.agg(F.sum(F.col("size") * pairs.tiles(F.col("size"), tile))).first()[0] or 0
    members = C.join_spread(members, sizes, "grp", "uid").join(same.drop("labels"), "uid")
    # a merge join whatever the sizes, so that the work is in proportion to the input
    packed = (
        texts.drop("text_key").join(members.hint("merge"), F.col("doc_id") == F.col("rep")).select("uid", "grp", "size", "n_docs", "set_hi", "set_lo", "text")
        .mapInArrow(_packed(words), "uid long, grp long, size long, n_docs long, shingles binary")
    )
    dealt = pairs.deal(packed, tile, -(-rows // SLOT_SETS) or 1, ("grp",)).select("slot", "grp", "uid", "mine", "ga", "gb", "n_docs", "shingles")
    found = C.materialize(dealt.groupBy("slot").applyInArrow(_verify(similarity), LINKS))
    C.release(docs.sparkSession)
    comps = C.connected_components(found.select(F.col("uid").alias("a"), F.col("root").alias("b"))).select(F.col("id").alias("uid"), F.col("component").alias("class"))
    links = found.groupBy("uid").agg(F.sum("links").alias("links"))
    return ids, same.drop("labels").join(links, "uid", "left").join(comps, "uid", "left")


def join(docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS, recall: float = RECALL, tile: int = TILE) -> DataFrame:
    """docs(doc_id, text) -> doc_id, class_id, copy_of, n_links, kept.

    copy_of is the first of the documents with the same set of shingles, class_id the
    smallest doc_id reachable by links, n_links the number of other rows linked directly,
    kept whether the document is the first of its class.
    """
    ids, members = _classified(docs, similarity, words, recall, tile)
    members = C.materialize(members)
    some, cols = F.col("class").isNotNull(), ["set_hi", "set_lo", "rep", "n_docs"]
    least = members.where(some).groupBy("class").agg(F.min("rep").alias("component"))
    by_set = (
        C.join_spread(members.where(some), least, "class", "uid").select(*cols, "links", "component")
        .unionByName(members.where(~some).select(*cols, F.lit(0).cast("long").alias("links"), F.col("rep").alias("component")))
    )
    out = ids.join(by_set, ["set_hi", "set_lo"], "left")
    return out.select(
        "doc_id", F.coalesce("component", "doc_id").alias("class_id"), F.coalesce("rep", "doc_id").alias("copy_of"),
        F.coalesce(F.col("links") + F.col("n_docs") - 1, F.lit(0)).cast("long").alias("n_links"),
        (F.coalesce("component", "doc_id") == F.col("doc_id")).alias("kept"),
    )


def keep_first(docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS, recall: float = RECALL, tile: int = TILE) -> DataFrame:
    """docs with one row of each class, that of the smallest doc_id (of several texts under it, the
    one of the smallest hash); columns stay.  Texts without words, and rows without doc_id, stay.
    """
    ids, members = _classified(docs, similarity, words, recall, tile)
    of_set = members.select("set_hi", "set_lo", F.coalesce("class", "uid").alias("class"))
    rows = C.materialize(
        ids.join(of_set, ["set_hi", "set_lo"]).groupBy("class", "doc_id", "text_key").agg(F.count("*").alias("n")))
    first = rows.groupBy("class").agg(F.min(F.struct("doc_id", "text_key")).alias("f"), F.sum("n").alias("every")).where("every > 1")  # others stay as they are
    fate = C.join_spread(rows, first, "class", "doc_id").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), (F.struct("doc_id", "text_key") == F.col("f")).alias("_first"), (F.col("n") > 1).alias("_again"),
    ).where("not _first or _again")
    fate = C.materialize(fate)
    C.release(docs.sparkSession)
    named = docs.where("doc_id is not null")
    whole = named.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("_doc"), F.xxhash64("text").alias("_text"))
    # both parts read one exchange of the rows; a merge join whatever the sizes, as above
    told = whole.join(fate.hint("merge"), (F.col("_doc") == F.col("_id")) & (F.col("_text") == F.col("_key")), "left")
    once, again = told.where("_first is null or (_first and not _again)"), told.where("_first and _again").dropDuplicates(["_doc", "_text"])
    return once.unionByName(again).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]).union(docs.where("doc_id is null"))
