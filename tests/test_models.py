import pathlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from colloquy.functions import text as T
from colloquy.operators import models as M
from colloquy.operators import rounds as R
from colloquy.operators import texts as O


def factory(log):
    """Upper-cases; refuses texts with 'bad'; logs its life."""

    class Model:
        def __init__(self):
            self.note("open")

        def note(self, what):
            with open(log, "a") as f:
                f.write(what + "\n")

        def run(self, batch):
            self.note(f"run {len(batch['text'])}")
            if any("bad" in (t or "") for t in batch["text"]):
                raise ValueError("bad text")
            return {"loud": [None if t is None else t.upper() for t in batch["text"]], "n": [len(t or "") for t in batch["text"]]}

        def close(self):
            self.note("close")

    return Model


def test_a_model_is_made_and_closed_once_a_task_and_called_with_batches(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"text {i}" if i != 7 else "bad one", "old") for i in range(40)] + [(40, None, "old")], "id long, text string, loud string").coalesce(1)
    got = {r.id: r for r in M.with_model(rows, factory(f"{tmp_path}/log"), "loud string, n int", ["text"], batch_rows=10).collect()}
    assert len(got) == 41 and got[3].loud == "TEXT 3" and got[3].n == 6 and got[3].error is None and got[40].loud is None
    assert got[7].loud is None and got[7].n is None and got[7].error == "ValueError: bad text"
    assert [k for k, r in got.items() if r.error] == [7]
    log = pathlib.Path(tmp_path / "log").read_text().split("\n")[:-1]
    assert log[0] == "open" and log[-1] == "close" and log.count("open") == log.count("close") == 1
    assert log.count("run 10") == 4 and log.count("run 1") == 11  # one batch again row by row


def test_results_that_are_not_as_declared_are_errors(spark):
    class Short:
        def run(self, batch):
            return {"x": [1] * (len(batch["id"]) - 1)}

    class Other:
        def run(self, batch):
            return {"y": batch["id"]}

    class Kind:
        def run(self, batch):
            return {"x": ["no number"] * len(batch["id"])}

    for model, message in ((Short, "values for 1 rows"), (Other, "declared are"), (Kind, "ArrowInvalid")):
        got = M.with_model(spark.range(3), model, "x long", ["id"]).collect()
        assert [r.id for r in got] == [0, 1, 2] and all(r.x is None and message in r.error for r in got)
    assert M.with_model(spark.range(0), Short, "x long", ["id"]).count() == 0


def test_tokenizers_take_each_others_place(spark):
    texts = [(0, "Hello there\nworld  again"), (1, ""), (2, None), (3, "\n\n"), (4, "über straße " * 50)]
    rows = spark.createDataFrame(texts, "id long, text string")
    want = {r.id: r.ids for r in rows.select("id", T.subword_tokens(F.col("text"), bos=1).alias("ids")).collect()}
    assert {r.id: r.ids for r in M.subword_tokens(rows, bos=1).collect()} == want
    model = pathlib.Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    text = pathlib.Path(public_tokenizers.path("byte_bpe_50k.json")).read_text()
    for make in (lambda: M.SentencePieces(model), lambda: M.LibraryTokens(text)):
        of, got = make(), {r.id: r for r in M.subword_tokens(rows.withColumnRenamed("text", "line"), make, text="line", newline=13).collect()}
        for i, t in texts:
            ids = None if t is None else [x for k, line in enumerate(t.split("\n")) for x in ([13] if k else []) + of.encode([line])[0]]
            assert got[i].ids == ids and got[i].error is None and got[i].line == t
    assert got[0].ids != want[0][1:]


def test_rounds_shrink_and_resume(spark, tmp_path):
    class Generator:
        """Lines by attempt; some ids only get a usable one later, 'never' none, and 'odd' raises at first."""

        def __init__(self, attempt):
            self.attempt = attempt

        def run(self, batch):
            def line(i):
                if i == "odd" and self.attempt == 0:
                    raise RuntimeError("out of memory")
                if i == "never" or (i.startswith("late") and self.attempt < int(i[4:])):
                    return "short"
                return f"A usable line for {i} at {self.attempt}"

            return {"raw_text": [line(i) for i in batch["id"]]}

    plan = spark.createDataFrame([(i, "sad") for i in ("a", "b", "late1", "late2", "never", "odd")], "id string, emotion string")
    asked = []

    def generate(frontier, attempt):
        asked.append((attempt, sorted(r.id for r in frontier.collect())))
        return M.with_model(frontier, lambda: Generator(attempt), "raw_text string", ["id"])

    def run(folder, n):
        out = R.accept_in_rounds(plan, generate, O.validated, F.lit("fallback line"), str(folder), rounds=n)
        return {r.id: (r.text, r.chosen) for r in out.collect()}

    got = run(tmp_path / "x", 3)
    assert asked == [(0, ["a", "b", "late1", "late2", "never", "odd"]), (1, ["late1", "late2", "never", "odd"]), (2, ["late2", "never"])]
    assert got["a"] == ("A usable line for a at 0", "first") and got["late1"][1] == got["late2"][1] == got["odd"][1] == "retry" and got["never"] == ("fallback line", "fallback")
    rows = R.run_rounds(plan, generate, O.validated, str(tmp_path / "x"), 3)
    assert {(r.attempt, r.outcome): r.n for r in R.round_report(rows).collect()}[(0, "generator")] == 1

    # a run that is killed in round 1 goes on there
    asked.clear()

    def killed(frontier, attempt):
        if attempt == 1:
            raise KeyboardInterrupt
        return generate(frontier, attempt)

    with pytest.raises(KeyboardInterrupt):
        R.run_rounds(plan, killed, O.validated, str(tmp_path / "y"), 3)
    assert run(tmp_path / "y", 3) == got
    assert [a for a, _ in asked] == [0, 1, 2]
