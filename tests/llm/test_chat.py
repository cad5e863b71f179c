import itertools
import random

import numpy as np
import pytest

from quietwire.llm import chat

ROWS = "conv_id bigint, turn bigint, role string, text string, position string, found string"


def rows_of(spark, rows):
    return spark.createDataFrame([(c, t, r, x, "p", "f") for c, t, r, x in rows], ROWS)


def lines_of(spark, rows):
    return rows_of(spark, rows).select("conv_id", "turn", "text")


@pytest.mark.parametrize("text,role,rest", [
    ("User: hello", "user", "hello"), ("[ASSISTANT]: yes", "assistant", "yes"), ("### Human: why?", "user", "why?"), ("<|system|>\nBe brief", "system", "Be brief"),
    ("Q: what", "user", "what"), ("a friend of mine", None, "a friend of mine"), ("Answering: no", None, "Answering: no"), ("", None, ""),
])
def test_markers(text, role, rest):
    found, left = chat.marker_of(text)
    assert (chat.ROLES[found - 1] if found else None, left) == (role, rest)


def random_model(seed):
    rng = np.random.default_rng(seed)
    logs = lambda *shape: np.log(rng.dirichlet(np.ones(shape[-1]), shape[:-1] or None))
    return chat.Model(logs(3), logs(3, 3), tuple(logs(3, n) for n in chat.SIZES))


def likelihood(model, scores, states):
    total = model.start[states[0]] + scores[0][states[0]]
    return total + sum(model.move[a, b] + scores[i + 1][b] for i, (a, b) in enumerate(zip(states, states[1:])))


def test_path_of_one_segment_is_the_likeliest():
    rng = np.random.default_rng(1)
    for seed in range(20):
        model, scores = random_model(seed), rng.normal(0, 2, (6, 3))
        table = chat.table_of(scores, model, True)
        states = chat.path_of(scores, model, -1, int(table[0].argmax()))
        best = max(itertools.product(range(3), repeat=6), key=lambda s: likelihood(model, scores, s))
        assert tuple(states) == best


@pytest.mark.parametrize("segment", [256, 7])
def test_segments_give_the_path_of_the_whole(spark, monkeypatch, segment):
    monkeypatch.setattr(chat, "SEGMENT", segment)
    rng = random.Random(2)
    texts = ["ok", "User: hi", "why so?", "a long line " * 30, "AI: sure.", "x\ny\nz", "", None]
    rows = [(c, t, None, rng.choice(texts)) for c, n in ((1, 1), (2, 3), (3, 100), (None, 20)) for t in range(n)]
    model = random_model(3)
    got = {(r.conv_id, r.turn): r.found for r in chat.decode(lines_of(spark, rows).repartition(4), model).collect()}
    for c in (1, 2, 3, None):
        mine = [x for i, _, _, x in rows if i == c]
        scores = model.lines(np.array([chat.features(x or "") for x in mine]))
        want = chat.path_of(scores, model, -1, int(chat.table_of(scores, model, True)[0].argmax()))
        found = [chat.ROLES.index(got[c, t]) for t in range(len(mine))]
        assert likelihood(model, scores, found) == pytest.approx(likelihood(model, scores, list(want)))


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        turn = 0
        if rng.random() < 0.3:
            rows.append((c, turn, "system", "Be helpful. " * rng.randint(2, 5)))
            turn = 1
        for k in range(rng.randint(1, 5)):
            rows.append((c, turn + 2 * k, "user", "short question " * rng.randint(1, 4) + rng.choice("?.")))
            rows.append((c, turn + 2 * k + 1, "assistant", "a far longer answer with lines.\n" * rng.randint(3, 20)))
    return rows


def test_roles_are_recovered_and_rendered(spark):
    rows = conversations(4, 200)
    model = chat.learn(rows_of(spark, rows).where("conv_id % 2 = 0"))
    out = chat.format_turns(lines_of(spark, rows), model).collect()
    want = {(c, t): (r, x) for c, t, r, x in rows}
    assert len(out) == len(rows)
    assert sum(want[r.conv_id, r.turn][0] == r.found for r in out) >= 0.97 * len(rows)
    for r in out:
        assert r.rendered == f"<|{r.found}|>\n{want[r.conv_id, r.turn][1].strip()}\n<|end|>\n"
        assert r.position == r.turn


def test_raw_transcripts_with_markers(spark):
    raw = "System: be kind\n\nUser: hello there\nand more\nAssistant: hi.\nHuman: bye\nBot: bye."
    lines = chat.transcript_lines(spark.createDataFrame([(1, raw), (2, None), (3, "")], "conv_id bigint, text string"))
    out = chat.format_turns(lines, chat.default_model()).orderBy("position").collect()
    roles = [r.found for r in out]
    assert [roles[i] for i in (0, 1, 3, 4, 5)] == ["system", "user", "assistant", "user", "assistant"]
    assert out[1].rendered == "<|user|>\nhello there\n<|end|>\n"


def test_nulls_ties_and_no_rows(spark):
    rows = [(1, None, None, None), (1, None, None, ""), (1, 1, None, "a"), (1, 1, None, "a"), (None, None, None, "x" * 100_000)]
    out = chat.format_turns(lines_of(spark, rows), chat.default_model()).collect()
    assert len(out) == 5 and {r.found for r in out} <= set(chat.ROLES)
    assert sorted(r.position for r in out if r.conv_id == 1) == [0, 1, 2, 3]
    nothing = rows_of(spark, rows).where("false")
    assert chat.format_turns(nothing, chat.learn(nothing)).count() == 0


@pytest.mark.parametrize("segment", [256, 3])
def test_lines_of_a_turn_are_joined(spark, monkeypatch, segment):
    monkeypatch.setattr(chat, "SEGMENT", segment)
    raw = "System: be kind\n\nUser: hello there\nand more\n\nand a third\nfourth\nfifth\nAssistant: hi.\nHuman: bye\nBot: bye.\n\n"
    transcripts = spark.createDataFrame([(1, raw), (2, None), (3, ""), (None, "Q: why\nso?")], "conv_id bigint, text string")
    out = chat.format_transcripts(transcripts, chat.default_line_model(), chat.default_model()).orderBy("conv_id", "position").collect()
    want = [(None, "user", "why\nso?"), (1, "system", "be kind"), (1, "user", "hello there\nand more\n\nand a third\nfourth\nfifth")]
    want += [(1, "assistant", "hi."), (1, "user", "bye"), (1, "assistant", "bye.")]
    assert [(r.conv_id, r.found, r.rendered) for r in out] == [(c, role, f"<|{role}|>\n{x}\n<|end|>\n") for c, role, x in want]


def test_turns_are_found_again_in_joined_conversations(spark):
    rows = conversations(6, 120)
    known = rows_of(spark, rows).where("conv_id % 2 = 0")
    out = chat.format_joined(lines_of(spark, rows).repartition(3), chat.learn_lines(known), chat.learn(known)).collect()
    want = {(c, t): (r, x.strip()) for c, t, r, x in rows}
    same = sum(want.get((r.conv_id, r.turn)) == (r.found, r.text) for r in out)
    assert len(out) == len(rows) and same >= 0.97 * len(rows)
