import hashlib
import random
from collections import Counter

from colloquy.llm import fingerprint as M

DOC = "doc_id long, text string"


def test_tree():
    a = "Intro line. Two.\nMore text here!\n\n# Head\nBody one. Body two? Body three.\nLast"
    b = a.replace("Body two?", "Body 2?")
    assert M.tree(a) == M.tree(str(a)) and M.tree(a).split("|")[0] != M.tree(b).split("|")[0]
    assert M.tree(a + " ").split("|")[0] != M.tree(a).split("|")[0]
    assert M.edits(M.tree(a), M.tree(b)) == [(1, 1, 1)] and M.edits(M.tree(a), M.tree(a)) == []
    assert 0.8 < M.likeness(M.tree(a), M.tree(b)) < 1 and M.likeness(M.tree(a), M.tree(a)) == 1
    assert M.likeness(M.tree(""), M.tree(None)) == 1 and M.likeness(M.tree(""), M.tree(a)) == 0
    assert M.likeness(M.tree("\n"), M.tree("")) == 0


def leaves(text):
    """Sentences, character by character: a sentence ends after its last mark of .!? and at a line's end."""
    out = Counter()
    for line in text.split("\n"):
        if not line.strip():
            continue
        now = ""
        for c in line:
            if now and now[-1] in ".!?" and c not in ".!?":
                out[now] += 1
                now = ""
            now += c
        if now:
            out[now] += 1
    return out


def test_likeness_against_sentences():
    rnd = random.Random(3)
    parts = ["One here.", " Two? ", "Three!!", "no stop", "\n", "\n\n", "# Head\n", "a.b.", "é😀 end."]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 12))) for _ in range(120)]
    for a, b in zip(texts, texts[1:] + texts[:1]):
        one, two = leaves(a), leaves(b)
        size = lambda c: sum(len(s) * n for s, n in c.items())
        want = 1.0 if a == b else 2 * size(one & two) / (size(one) + size(two)) if one or two else 0.0
        assert abs(M.likeness(M.tree(a), M.tree(b)) - want) < 1e-9, (a, b)
        assert (M.tree(a).split("|")[0] == M.tree(b).split("|")[0]) == (a == b)


def slow_pieces(text):
    """Character by character, with Python's own integers."""
    if len(text) <= M.MOST:
        return [text]
    powers = [0x9E3779B97F4A7C15 * 0xD6E8FEB86659FD93**k for k in range(M.WINDOW)]
    out, now = [], ""
    for i, c in enumerate(text):
        now += c
        h = sum(ord(text[i - k]) * powers[k] for k in range(min(i + 1, M.WINDOW))) % 2**64
        if len(now) == M.MOST or (h >> 58 == 0 and len(now) >= M.LEAST):
            out.append(now)
            now = ""
    return out + [now] if now else out


def test_pieces_of_long_sentences(monkeypatch):
    rnd = random.Random(8)
    for text in ["x" * 1000, "", "ab", "y" * 128, "y" * 129, "é😀" * 300, *("".join(rnd.choices("abc é本\ud800", k=rnd.randint(200, 3000))) for _ in range(40))]:
        cut = lambda t: [t[i:j] for e in [M.pieces(0, len(t), M.marks(t)) if len(t) > M.MOST else [len(t)]] for i, j in zip([0, *e], e)]
        want, size = cut(text), M.SLICE
        assert want == slow_pieces(text) and "".join(want) == text
        monkeypatch.setattr(M, "SLICE", 100)
        assert cut(text) == want
        monkeypatch.setattr(M, "SLICE", size)
        # a leaf does not depend on what stands before its sentence
        assert [x for x in M.tree(f"Before. And é this!\n\nMore.{text}").split("|")[-1][17:].split(",")[1:]] == [M._leaf(p) for p in want if p]
    words = [f"w{rnd.randrange(5000)}" for _ in range(3000)]
    one = " ".join(words)
    assert 40 < len(one) / len(slow_pieces(one)) < 160
    for at in (0, 1500, 2999):  # one word changed, one put in, one taken out: the rest of the leaves stay
        for new in (words[:at] + ["other"] + words[at + 1 :], words[:at] + ["more"] + words[at:], words[:at] + words[at + 1 :]):
            assert 0.95 < M.likeness(M.tree(one), M.tree(" ".join(new))) < 1
    assert 0.6 < M.likeness(M.tree(one), M.tree(M.edited(one, "other " * 5000))) < 0.7


def test_full_width_stops():
    a, b = "第一句。第二句！第三句？", "第一句。第二句！第四句？"
    assert abs(M.likeness(M.tree(a), M.tree(b)) - 2 / 3) < 1e-9


def brute(docs):
    rows = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))
    out = []
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1] or ""
        new = M.edited(t or "", nxt)
        one, two = M.tree(t), M.tree(new)
        out.append((d, len(t or ""), hashlib.sha256(new.encode()).hexdigest(), one, two, M.likeness(one, two), M.likeness(one, M.tree(nxt))))
    return sorted(out, key=str)


def test_next_document(spark, monkeypatch):
    docs = [(i * 7 % 101, f"Text {i} é😀. " * (i % 9) + "\n" + "Line. " * (i % 4)) for i in range(90)] + [(500, None), (501, ""), (None, "no id at all"), (-4, "below")]
    for size in (1 << 23, 900, 100):
        got = M.compare_with_next(spark.createDataFrame([(*d, "x") for d in docs], DOC + ", bucket string").repartition(5), size).collect()
        assert sorted(map(tuple, got), key=str) == brute(docs)
    monkeypatch.setattr(M, "MOST_BUCKETS", 3)
    assert sorted(map(tuple, M.compare_with_next(spark.createDataFrame(docs, DOC), 100).collect()), key=str) == brute(docs)


def test_small_tables(spark):
    assert M.compare_with_next(spark.createDataFrame([], DOC)).collect() == []
    one = M.compare_with_next(spark.createDataFrame([(1, "abcdef")], DOC)).collect()[0]
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    two = M.compare_with_next(spark.createDataFrame([(1, "same"), (1, "same")], DOC)).collect()
    assert [r.near_next for r in two] == [1.0, 1.0]
    assert M.fingerprint(spark.createDataFrame([(1, None, "f")], DOC + ", fingerprint string")).first().fingerprint == M.tree("")


def test_repeated_id_over_several_buckets(spark):
    docs = [(5, f"Line {i}. " * 40) for i in range(60)] + [(5, "Line 3. " * 40)] * 3 + [(9, "first"), (1, "last")]
    got = M.compare_with_next(spark.createDataFrame(docs, DOC), 2000).collect()
    assert sorted(r.doc_id for r in got) == sorted(d for d, _ in docs)
    whole = M.compare_with_next(spark.createDataFrame(docs, DOC)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, whole))


def test_long_text(spark):
    long = "A sentence of some length. " * 100_000
    rows = M.compare_with_next(spark.createDataFrame([(2, long), (1, long + "End.")], DOC)).collect()
    assert all(0.99 < r.near_next < 1 for r in rows)
