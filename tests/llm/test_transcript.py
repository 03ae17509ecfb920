import itertools

import numpy as np
import pytest
from siltbed.llm import queries, transcript
from siltbed.llm.shared import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    return transcript.train(queries.transcripts(spark.read.parquet(f"{SF}/conversations.parquet")))


def best_by_brute_force(model, symbols):
    """All state sequences of a few lines."""
    found = max(
        (model.moves[transcript.START, path[0]] + sum(model.moves[a, b] for a, b in zip(path, path[1:])) + sum(model.shows[s, o] for s, o in zip(path, symbols)), path)
        for path in itertools.product(range(transcript.STATES), repeat=len(symbols))
    )
    return found[0]


def score(model, symbols, path):
    return model.moves[transcript.START, path[0]] + sum(model.moves[a, b] for a, b in zip(path, path[1:])) + sum(model.shows[s, o] for s, o in zip(path, symbols))


def test_segments_give_the_best_path(model):
    rnd = np.random.default_rng(1)
    for _ in range(20):
        symbols = rnd.integers(0, transcript.SYMBOLS, 6).tolist()
        parts = [symbols[:2], symbols[2:3], symbols[3:]]
        ends = transcript.chain([model.passage(p)[0] for p in parts])
        path = [s for p, before, last in zip(parts, [transcript.START, *ends], ends) for s in model.trace(p, before, last)]
        assert score(model, symbols, path) == pytest.approx(best_by_brute_force(model, symbols))


def test_roles_are_recovered(spark, model):
    messages = queries.transcripts(spark.read.parquet(f"{SF}/conversations.parquet"))
    truth = {(r.conv_id, r.turn): r.role for r in messages.collect()}
    turns = transcript.parse(messages.drop("role"), model, stored=stored).where("begins").collect()
    assert np.mean([truth[t.conv_id, t.position] == t.role for t in turns]) > 0.9
    assert all(t.rendered == f"<|im_start|>{t.role}\n{t.content}<|im_end|>\n" for t in turns if t.ends)


def canonical(turns):
    return "".join(t.rendered for t in sorted(turns, key=lambda t: (t.conv_id is not None, t.conv_id or 0, t.segment, t.part)))


def test_segment_size_changes_nothing(spark, model, monkeypatch):
    rows = [(c, t, f"{'User: ' if t % 3 == 0 else ''}line {t}\nmore?\n\nend" if t % 2 else "AI: well") for c in (1, 2, None) for t in range(30)]
    rows += [(3, None, None), (3, 1, ""), (3, 1, "System: be good"), (3, 1, "System: be good"), (4, 0, "x\n" * 5000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, text string").repartition(3)
    whole = canonical(transcript.parse(frame, model).collect())
    monkeypatch.setattr(transcript, "SEGMENT", 2)
    assert canonical(transcript.parse(frame, model).collect()) == whole
    assert whole.count("<|im_start|>") == whole.count("<|im_end|>")


def test_empty_table_and_no_roles(spark, model):
    none = spark.createDataFrame([], "conv_id long, turn long, text string, role string, segment int")
    assert transcript.parse(none, transcript.train(none)).count() == 0


def test_markers():
    for line, role, rest in (("User: hi", "user", "hi"), ("### Response: x", "assistant", "x"), ("**Human:** y", "user", "y"), ("<|assistant|> z", None, "<|assistant|> z"), ("Note: no", None, "Note: no"), ("[SYSTEM]: a", "system", "a"), ("A: b", "assistant", "b"), ("### User", "user", "")):
        assert transcript.split_marker(line) == (role, rest), line


def test_one_text_of_many_turns(spark, model, monkeypatch):
    """Borders of pieces tell nothing: markers alone do, wherever they stand."""
    text = "\n\nUser: what is it?\nsay more\n\n\nplease\n\nAssistant:\n\nwell\nit is so\nUser: thanks\nAssistant: welcome\n \n"
    want = [("user", "what is it?\nsay more\n\n\nplease"), ("assistant", "well\nit is so"), ("user", "thanks"), ("assistant", "welcome")]
    whole = spark.createDataFrame([(1, 0, text)], "conv_id long, turn long, text string")
    lines = spark.createDataFrame([(1, k, x) for k, x in enumerate(text.split("\n"))], whole.schema)
    for size in (256, 1, 3):
        monkeypatch.setattr(transcript, "SEGMENT", size)
        monkeypatch.setattr(transcript, "PIECES", size)
        for frame in (whole, lines):
            turns = transcript.parse(frame, model).collect()
            assert canonical(turns) == "".join(f"<|im_start|>{r}\n{c}<|im_end|>\n" for r, c in want)


def test_query_learns_from_other_conversations(spark, monkeypatch):
    train, parse, learned, parsed = transcript.train, transcript.parse, [], []
    ids = lambda rows: {r.conv_id for r in rows.select("conv_id").distinct().collect()}
    monkeypatch.setattr(transcript, "train", lambda rows: (learned.append(ids(rows)), train(rows))[1])
    monkeypatch.setattr(transcript, "parse", lambda rows, model, **k: (parsed.append(ids(rows)), parse(rows, model, **k))[1])
    found = queries.op3_transcripts(spark, SF)
    assert all(not a & b for a, b in zip(learned, parsed))
    assert set.union(*parsed) == ids(spark.read.parquet(f"{SF}/conversations.parquet")) == ids(found)
