"""Perspective rotation against a plain rendering."""

import duckdb

from orderlake.llm import chat, oracles, queries
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.001"


def brute(turns, speaker):
    text, masks = "", []
    for role, body in turns:
        head = "<|assistant|>\n" if role == speaker else "<|system|>\n" if role == "system" else f"<|user name={role.replace('<|', '< |')}|>\n"
        body = body.replace("<|", "< |") + "<|end|>"
        if role == speaker:
            masks.append((len(text) + len(head), len(text) + len(head) + len(body)))
        text += head + body + "\n"
    return text, masks


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece int, masks int")


def test_every_participant_and_masks(spark):
    turns = [("system", "be kind"), ("ann", "hi <|end|> é"), ("bob", ""), ("ann", "x\ny"), ("<|cy", "😀"), ("unknown", "q")]
    rows = [(4, k, None if r == "unknown" else r, t or None, 1, 1) for k, (r, t) in enumerate(turns)]
    got = {r.participant: r for r in chat.rotate(frame(spark, rows[::-1] + rows[:2])).collect()}
    assert set(got) == {"ann", "bob", "<|cy", "unknown"}
    for speaker, r in got.items():
        text, masks = brute(turns, speaker)
        assert r.rendered == text and [(m.start, m.end) for m in r.masks] == masks and r.n_turns == 6 and r.n_own == len(masks)


def test_long_conversations_come_in_pieces(spark):
    rows = [(1, k % 40, f"p{k % 3}", prose(k, 3), 0, 0) for k in range(100)] + [(2, 0, "a", "x", 0, 0), (None, None, "a", "y", 0, 0)]
    got = chat.rotate(frame(spark, rows + rows[:30]), piece_turns=16).collect()
    order = sorted(((t, r, x) for c, t, r, x, *_ in rows if c == 1))
    for r in got:
        if r.conv_id == 1:
            part = [(role, x) for _, role, x in order[r.piece * 16:r.piece * 16 + 16]]
            assert r.participant in ("p0", "p1", "p2")
            assert (r.rendered, [(m.start, m.end) for m in r.masks]) == brute(part, r.participant) and r.n_turns == len(part)
    assert sum(r.n_own for r in got if r.conv_id == 1) == 100
    assert {(r.conv_id, r.n_turns) for r in got if r.conv_id != 1} == {(2, 1), (None, 1)}


def test_a_silent_speaker_and_the_system_turn_in_force_reach_every_piece(spark):
    """600 turns: early speaks only in the first ten, system turns stand at 0, 5 and 300, one piece has its own."""
    roles = {0: "system", 5: "system", 300: "system"}
    rows = [(1, k, roles.get(k, "early" if k in (1, 9) else f"p{k % 2}"), f"turn {k}", 0, 0) for k in range(600)]
    rows += [(2, k, "late" if k else "x", f"other {k}", 0, 0) for k in range(300)]
    got = {(r.conv_id, r.piece, r.participant): r for r in chat.rotate(frame(spark, rows).repartition(5)).collect()}
    assert set(got) == {(1, p, w) for p in range(3) for w in ("early", "p0", "p1")} | {(2, p, w) for p in range(2) for w in ("late", "x")}
    for (conv, piece, who), r in got.items():
        own = [(role, x) for c, _, role, x, *_ in rows if c == conv]
        part, ahead = own[piece * 256:piece * 256 + 256], [t for t in own[:piece * 256] if t[0] == "system"]
        assert (r.rendered, [(m.start, m.end) for m in r.masks]) == brute(ahead[-1:] + part, who)
        assert r.n_turns == len(part) and r.n_own == sum(t[0] == who for t in part)
    con = duckdb.connect()
    con.register("conversations", frame(spark, rows).select("conv_id", "turn", "role", "text").toPandas())
    want = {(r[0], r[1], r[2]): r[3:] for r in con.execute(oracles.OP5).fetchall()}
    assert {k: (r.n_turns, r.n_own, len(r.rendered)) for k, r in got.items()} == {k: v[:3] for k, v in want.items()}


def test_query_matches_sql_and_empty_tables(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{SF}/conversations.parquet')")
    want = con.execute(oracles.OP5)
    names = [d[0] for d in want.description]
    got = queries.QUERIES["op5_perspectives"](spark, SF).select(*names).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall())) and got
    assert chat.rotate(frame(spark, [])).collect() == []
    assert chat.rotate(frame(spark, [(1, 0, "system", "only", 0, 0)])).collect() == []
