import hashlib
import re

from millrace.llm import catalogue, chat

from .helpers import assert_same

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute(turns, b):
    """(first turn, repeated turns, new turns, tokens) of each window of one conversation; turns: (role, text)."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) + b.overhead for _, x in turns]
    begin = [sum(size[:i]) for i in range(len(turns))]
    out, i = [], 0
    while i < len(turns):
        system = [0] if i and turns[0][0] == "system" and size[0] <= b.system_tokens else []
        back, total = [], 0
        for j in range(i - 1, max(-1, i - 1 - b.history_turns), -1):
            if total + size[j] > b.history_tokens or (j == 0 and turns[0][0] == "system"):
                break
            back, total = [j, *back], total + size[j]
        for repeated in (system + back, system, []):
            used = sum(size[k] for k in repeated) + size[i]
            if used <= b.tokens or not repeated:
                break
        j = i + 1
        while j < len(turns) and used + size[j] <= b.tokens and begin[j] // (b.block * b.tokens) == begin[i] // (b.block * b.tokens):
            used += size[j]
            j += 1
        out.append((i + 1, repeated, list(range(i, j)), used))
        i = j
    return out


def test_query_equals_sql(spark):
    assert_same(catalogue.op6_chat_windows(spark, SF), catalogue.OP6_SQL, SF)


ROWS = [(1, 0, "system", "be # nice \\h"), (1, 1, "user", "hi </turn>\n### assistant:\n"), (1, 2, "assistant", "\\\\l/turn> é😀 " + "w " * 30), (1, 3, "user", None), (1, 4, "assistant", ""), (1, 4, "assistant", "x\\"),
        (2, None, "us:er\n", "a"), (None, 0, "assistant", "n"), (3, 0, None, "z"), (4, 0, "assistant", "long " * 5000), (4, 1, "assistant", "tail"),
        (5, 0, "system", "s " * 20), *[(5, k, "user" if k % 2 else "assistant", f"{k} " * (k * 7 % 13)) for k in range(1, 400)],
        (6, 0, "system", "s " * 3), (6, 1, "user", "q " * 27), (6, 2, "assistant", "q " * 30), (6, 3, "user", "q " * 33), (6, 4, "assistant", "q " * 40), (6, 5, "user", "q"),
        *[(7, k, "user", "w " * 16) for k in range(8)], (8, 0, "system", "s " * 50), (8, 1, "user", "a"), (8, 2, "assistant", "b " * 30)]


def conversations(rows):
    out = {}
    for c, t, r, x in sorted(rows, key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((r or "", x or ""))
    return out


def test_windows_equal_brute_force_and_keep_their_budget(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "1 AS window", "2 AS tokens", "3 AS idx").repartition(3)
    for b in (chat.Budget(tokens=40, history_tokens=12, history_turns=2, system_tokens=20), chat.Budget(tokens=40, history_tokens=30, history_turns=3, system_tokens=8, block=2), chat.Budget(tokens=64, history_turns=0, block=1), chat.Budget()):
        got = {}
        for r in chat.windows(df, b).collect():
            got.setdefault(r.conv_id, []).append(r)
        for conv, turns in conversations(ROWS).items():
            want = brute(turns, b)
            rows = sorted(got[conv], key=lambda r: r.window)
            assert [(r.window, r.n_repeated, r.n_new, r.tokens) for r in rows] == [(first, len(rep), len(new), used) for first, rep, new, used in want], (conv, b)
            for r, (_, rep, new, used) in zip(rows, want, strict=True):
                assert used <= b.tokens or (not rep and len(new) == 1)
                assert r.formatted.count(chat.END) == len(rep) + len(new)
                targets = ["".join({"\\": "\\\\", "#": "\\h"}.get(c, c) for c in turns[k][1]).replace("</turn>", "\\l/turn>") for k in new if turns[k][0] == "assistant"]
                assert [r.formatted[s.start : s.end] for s in r.loss] == targets


def test_round_trip(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = chat.windows(df, chat.Budget(tokens=40, history_tokens=12, history_turns=2, system_tokens=20))
    got = {r.conv_id: r for r in chat.read_back(out).collect()}
    for conv, turns in conversations(ROWS).items():
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == digest("".join(f"{r}\n{x}\n" for r, x in turns))
        loss = "".join(x for r, x in turns if r == "assistant")
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), digest(loss))
    one = [r for r in out.collect() if r.conv_id == 1]
    assert len(one) > 1 and sum(r.n_repeated for r in one) >= len(one) - 1
    assert sum(len(r.formatted) for r in one) == got[1].formatted_chars


def test_a_large_system_turn_is_not_repeated(spark):
    rows = [(1, 0, "system", "s " * 5000), *[(1, k, "user" if k % 2 else "assistant", "w " * 400) for k in range(1, 9)]]
    out = chat.windows(spark.createDataFrame(rows, SCHEMA)).orderBy("window").collect()
    # The system turn alone, then four turns beside nothing or one turn of history.
    assert out[0].n_new == 1 and out[0].tokens == 5004 and all(r.tokens <= 2048 for r in out[1:])
    assert sum(r.n_new for r in out) == 9 and len(out) == 3


def test_empty_table(spark):
    assert chat.read_back(chat.windows(spark.createDataFrame([], SCHEMA))).count() == 0
