"""Functions given by the user as operators: text generators, tokenizers, speech and codec models.

A model is made once for each task by a factory (a picklable callable without arguments), is
called with batches, and is closed when the task ends, also after an error:

    class Shout:                                   # or any object with run()
        def run(self, batch):                      # dict of column name -> list
            return {"loud": [t.upper() for t in batch["text"]]}
        def close(self): ...                       # optional

    with_model(rows, Shout, "loud string", inputs=["text"])

If a call fails, its rows are given one by one, and those that fail again get nulls and the
error's text; other rows and batches are not touched.  A result of another length or type than
declared is an error of its rows.  Only the input columns are turned into Python values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

ERROR = "error"


def _called(model, rows: dict[str, list], n: int, kinds: dict[str, pa.DataType]) -> list[pa.Array]:
    """The model's columns for one call."""
    got = model.run(rows)
    if set(got) != set(kinds):
        raise ValueError(f"the model gave {sorted(got)}, declared are {sorted(kinds)}")
    out = [pa.array(got[c], kind) for c, kind in kinds.items()]
    if any(len(x) != n for x in out):
        raise ValueError(f"the model gave {[len(x) for x in out]} values for {n} rows")
    return out


def _one_by_one(model, rows: dict[str, list], n: int, kinds: dict[str, pa.DataType]) -> tuple[list[pa.Array], list[str | None]]:
    columns: list[list[pa.Array]] = [[] for _ in kinds]
    errors: list[str | None] = []
    for k in range(n):
        try:
            got, error = _called(model, {c: v[k : k + 1] for c, v in rows.items()}, 1, kinds), None
        except Exception as e:
            got, error = [pa.nulls(1, kind) for kind in kinds.values()], f"{type(e).__name__}: {e}"
        errors.append(error)
        for held, x in zip(columns, got):
            held.append(x)
    return [pa.concat_arrays(x) if x else pa.array([], kind) for x, kind in zip(columns, kinds.values())], errors


def with_model(rows: DataFrame, factory: Callable, schema: str, inputs: Sequence[str], batch_rows: int = 256) -> DataFrame:
    """rows with the model's columns (DDL in schema; they replace those of their names) and `error`, null where all went well."""
    added = T.StructType.fromDDL(schema)
    kept = [c for c in rows.columns if c not in added.names and c != ERROR]
    kinds = {f.name: to_arrow_type(f.dataType) for f in added}
    inputs = list(inputs)
    given = [f"_in{k}" for k in range(len(inputs))]
    table = rows.select(*[rows[f"`{c}`"] for c in kept], *[rows[f"`{c}`"].alias(g) for c, g in zip(inputs, given)])
    out = T.StructType([*table.select(*[f"`{c}`" for c in kept]).schema, *added, T.StructField(ERROR, T.StringType())])

    def run(batches):
        model = factory()
        try:
            for whole in batches:
                for at in range(0, whole.num_rows, batch_rows):
                    batch = whole.slice(at, batch_rows)
                    n, values = batch.num_rows, {c: batch.column(g).to_pylist() for c, g in zip(inputs, given)}
                    try:
                        got, errors = _called(model, values, n, kinds), [None] * n
                    except Exception:
                        got, errors = _one_by_one(model, values, n, kinds)
                    yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *got, pa.array(errors, pa.string())], names=out.names)
        finally:
            if hasattr(model, "close"):
                model.close()

    return table.mapInArrow(run, out)


# ---------------------------------------------------------------- tokenizers
class HashPieces:
    """The stand-in of functions.text.subword_tokens: pieces of so many characters, numbered by their hash."""

    def __init__(self, size: int = 4, vocabulary: int = 32_000):
        import hashlib
        import re

        self.piece, self.span, self.known = re.compile(r"[^ \t]{1,%d}" % size), vocabulary - 10, {}
        self.number = lambda p: int(hashlib.md5(p.encode()).hexdigest()[:8], 16) % self.span + 10

    def encode(self, texts: list[str]) -> list[list[int]]:
        out = []
        for t in texts:
            pieces = self.piece.findall(t)
            for p in pieces:
                if p not in self.known:
                    if len(self.known) > 200_000:
                        self.known.clear()
                    self.known[p] = self.number(p)
            out.append([self.known[p] for p in pieces])
        return out


class SentencePieces:
    """A sentencepiece model given by its bytes."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.of = sentencepiece.SentencePieceProcessor(model_proto=model)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.of.encode(texts, num_threads=1)


class LibraryTokens:
    """A tokenizer of the tokenizers library given by its JSON text."""

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        self.of = Tokenizer.from_str(text)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.of.encode_batch_fast(texts, add_special_tokens=False)]


class _Lines:
    """Texts by lines, joined by the newline's id."""

    def __init__(self, tokenizer, text: str, newline: int, bos: int | None):
        self.of, self.text, self.newline, self.begin = tokenizer, text, newline, [] if bos is None else [bos]

    def run(self, batch):
        lines, ends = [], []
        for t in batch[self.text]:
            if t is not None:
                lines += t.split("\n")
            ends.append(None if t is None else len(lines))
        ids, out, at = self.of.encode(lines), [], 0
        for end in ends:
            if end is None:
                out.append(None)
                continue
            one = list(self.begin)
            for k in range(at, end):
                if k > at:
                    one.append(self.newline)
                one += ids[k]
            out.append(one)
            at = end
        return {"ids": out}


def subword_tokens(rows: DataFrame, tokenizer: Callable = HashPieces, text: str = "text", newline: int = 4, bos: int | None = None) -> DataFrame:
    """rows with ids (array<long>) and error.  tokenizer: a factory of objects with encode(texts) -> lists of ids."""
    return with_model(rows, lambda: _Lines(tokenizer(), text, newline, bos), "ids array<long>", [text])
