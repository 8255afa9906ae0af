"""Transcript parsing: Viterbi against enumeration, roles recovered, edge cases."""
import itertools
import random

import numpy as np

from feedloom.llm import queries as Q
from feedloom.llm import transcripts as T


def test_viterbi_is_the_best_path():
    rnd = random.Random(1)
    model = T.Hmm.default()
    for _ in range(15):
        seen = [rnd.randrange(T.N_SEEN) for _ in range(5)]

        def score(path):
            with np.errstate(invalid="ignore"):
                return model.first[path[0]] + sum(model.show[s, o] for s, o in zip(path, seen)) + sum(model.move[a, b] for a, b in zip(path, path[1:]))
        best = max(score(p) for p in itertools.product(range(len(T.STATES)), repeat=5))
        assert abs(score(model.viterbi(seen)) - best) < 1e-9
    assert model.viterbi([]) == []


def test_markers():
    for line, role in [("User: hi", "user"), ("### Response: x", "assistant"), ("[SYSTEM] y", "system"), ("<|user|> q", "user"),
                       ("**AI:** z", "assistant"), ("Q: what?", "user"), ("A: that", "assistant")]:
        symbol, rest = T.see(line)
        assert symbol // 6 == 1 + T.ROLES.index(role) and len(rest) <= 5
    assert T.see("Robin: hello")[0] // 6 == len(T.ROLES) + 1 and T.see("Robin: hello")[1] == "Robin: hello"
    assert T.see("plain words")[0] // 6 == 0 and T.see("http://x")[0] // 6 == 0


def test_parse_and_render():
    text = "System: be brief\nUser: what is it?\nand why?\nAssistant: a thing\n\nwith lines\nUser: thanks"
    turns = T.parse(text, T.Hmm.default())
    assert turns == [("system", "be brief"), ("user", "what is it?\nand why?"), ("assistant", "a thing\n\nwith lines"), ("user", "thanks")]
    assert T.render(turns[:1]) == "<|im_start|>system\nbe brief<|im_end|>\n"
    unnamed = T.parse("Ann: can you help me today?\nBob: yes\nAnn: how does it work?\nBob: well", T.Hmm.default())
    assert [r for r, _ in unnamed] == ["user", "assistant", "user", "assistant"]


def test_edge_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n ", "x"), (4, "hello", "x"), (None, "User: a\nAssistant: b", "x"), (4, "hello", "x"),
            (5, "User: a\nAssistant: b\n" * 20_000, None)]
    df = spark.createDataFrame(rows, "row long, text string, turns string")
    got = T.format_chats(df).collect()
    by = {r.row.row: r for r in got}
    assert len(got) == 7 and [len(by[i].turns) for i in (1, 2, 3, 4, None, 5)] == [0, 0, 0, 1, 2, 40_000]
    assert by[1].rendered == "" and by[4].rendered == "<|im_start|>user\nhello<|im_end|>\n"
    assert T.format_chats(df.limit(0)).count() == 0
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    raw = T.transcripts_of(none)
    assert raw.count() == 0 and np.allclose(T.fit(raw).first, T.Hmm.default().first)
    odd = spark.createDataFrame([(1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 0, "bard", "x"), (None, 200, "user", None)],
                                "conv_id long, turn long, role string, text string")
    raw = T.transcripts_of(odd)
    assert {(r.conv_id, r.part, len(r.roles)) for r in raw.collect()} == {(1, 0, 3), (None, 0, 1), (None, 3, 1)}
    assert T.format_chats(raw, T.fit(raw)).count() == 3


def test_turns_without_a_conversation_are_not_one_group(spark):
    df = spark.createDataFrame([(None if i % 3 == 0 else i // 9, i % 9, "user", f"t{i}") for i in range(900)], "conv_id long, turn long, role string, text string")
    raw = T.transcripts_of(df).collect()
    assert max(len(r.roles) for r in raw) <= 9 and sum(r.conv_id is None for r in raw) == 300 and sum(len(r.roles) for r in raw) == 900


def test_parts_are_parsed_as_one_transcript(spark):
    rnd, model = random.Random(8), T.Hmm.default()
    line = lambda: rnd.choice(["User: ", "Assistant: ", "", "", "Kim: ", "Q: "]) + " ".join(["word"] * rnd.randrange(1, 12)) + rnd.choice(["", "?"])
    convs = {c: [[line() for _ in range(rnd.randrange(1, 9))] for _ in range(rnd.choice([1, 2, 3, 30]))] for c in range(40)}
    convs[7] = [[line()] for _ in range(300)]  # most parts are of one conversation
    rows = [(c, 3 * k - 5, "\n".join(lines)) for c, parts in convs.items() for k, lines in enumerate(parts)]
    rows += [(None, 0, "User: a"), (None, 1, "User: b"), (50, None, "User: c"), (51, 0, None), (51, 1, "  "), (51, 2, "User: d")]
    rnd.shuffle(rows)
    spark.conf.set("spark.sql.shuffle.partitions", 9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        df = spark.createDataFrame(rows, "conv_id long, part int, text string")
        got = {(r.row.conv_id, r.row.part): r for r in T.format_chats(df, model, parts=("conv_id", "part")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    assert len(got) == len(rows)
    for c, parts in convs.items():
        whole = [T.see(x)[0] for lines in parts for x in lines]
        path = [T.STATES[s] for s in model.viterbi(whole)]
        at = 0
        for k, lines in enumerate(parts):
            mine = path[at:at + len(lines)]
            want = [role for i, (role, begins) in enumerate(mine) if begins or i == 0]
            assert [t.role for t in got[c, 3 * k - 5].turns] == want, (c, k)
            at += len(lines)
    assert [len(got[k].turns) for k in ((None, 0), (50, None), (51, 0), (51, 1), (51, 2))] == [1, 1, 0, 0, 1]
    alone = T.format_chats(df.filter("conv_id = 7"), model).collect()  # without their context, parts look otherwise
    assert sum([t.role for t in r.turns] != [t.role for t in got[7, r.row.part].turns] for r in alone) > 5


def test_query_recovers_held_out_roles(spark):
    got = Q.queries()["op3_chat_format"](spark, "/root/testdata/sf0.01").collect()
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert sum(r.n_turns for r in got) == turns.count()
    held = [r for r in got if r.held_out]
    assert held and sum(r.n_right for r in held) / sum(r.n_turns for r in held) >= 0.9
    assert all(r.rendered.count("<|im_start|>") == r.n_found for r in got)
