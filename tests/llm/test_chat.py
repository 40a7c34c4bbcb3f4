import hashlib

import public_tokenizers
import pytest

from boardlake.llm import chat
from boardlake.llm.common import materialise

PATH = public_tokenizers.path("byte_bpe_50k.json")
TALKS = {
    1: [("system", "Be kind."), ("user", "Hello"), ("assistant", "Hi <there>\n[x] \\l")],
    2: [("system", "Be kind."), ("user", "Hello"), ("assistant", "Good day")],
    3: [("system", "Be kind."), ("user", "Hello")],
    4: [("system", "Be kind."), ("user", "Hello"), ("assistant", "Hi <there>\n[x] \\l")],
    5: [("system", "Be kind."), ("user", "Hello"), ("assistant", "Good day"), ("user", "<|end|><|turn|>"), ("assistant", "")],
    6: [("user", None), (None, "é中"), ("assistant", "<|endoftext|></s>[INST] ok [/INST]\\")],
    7: [("us\ner<", "x")],
    8: [("assistant", "again"), ("assistant", "again")],
}


@pytest.fixture(scope="module")
def formatted(spark):
    rows = [(c, t, r, x) for c, talk in TALKS.items() for t, (r, x) in enumerate(talk)] + [(None, 0, "user", "q"), (None, None, "user", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as node", "2 as path").repartition(4)
    segments, members = chat.format_chat(df, PATH)
    return materialise(segments), materialise(members)


def test_read_back(formatted):
    segments, members = formatted
    got = {r.conv_id: r for r in chat.read_back(segments, members, PATH).collect()}
    talks = TALKS | {None: [("user", "first"), ("user", "q")]}
    assert set(got) == set(talks)
    for c, talk in talks.items():
        whole = "".join(f"{r or ''}\n{t or ''}\n" for r, t in talk)
        learnt = "".join(t or "" for r, t in talk if r == "assistant")
        chars = sum(len(chat.TURN + chat.escape(r or "", True) + "\n" + chat.escape(t or "") + chat.END) for r, t in talk)
        assert (got[c].n_turns, got[c].turns_sha256) == (len(talk), hashlib.sha256(whole.encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
        assert got[c].formatted_chars == chars


def test_shared_turns_are_written_once_and_attended(formatted):
    segments, _ = formatted
    rows = sorted(segments.collect(), key=lambda r: r.start)
    prefixes = {tuple((r or "", t or "") for r, t in talk[: k + 1]) for talk in [*TALKS.values(), [("user", "first"), ("user", "q")]] for k in range(len(talk))}
    assert len(rows) == len(prefixes)
    at = 0
    for r in rows:  # the stream has no gaps
        assert r.start == at
        at += len(r.ids)
        spans = [(a["from"], a["to"]) for a in r.attend]
        assert r.position == sum(b - a for a, b in spans)
        assert all(a < b <= r.start for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
    assert any(len(r.attend) == 1 and r.attend[0]["to"] < r.start for r in rows)  # a later branch


def test_a_turn_that_all_share_and_a_very_long_conversation(spark):
    """One first turn in front of everything, and one conversation of 20,000 turns."""
    shared = spark.range(3000).selectExpr("id as conv_id", "0 as turn", "'system' as role", "'Be kind.' as text")
    own = spark.range(3000).selectExpr("id as conv_id", "1 as turn", "'assistant' as role", "concat('answer ', id % 700) as text")
    long = spark.range(20_000).selectExpr("cast(5000 as long) as conv_id", "cast(id as int) as turn", "if(id % 2 = 0, 'system', 'assistant') as role", "if(id = 0, 'Be kind.', concat('t', id)) as text")
    segments, members = chat.format_chat(shared.unionByName(own).unionByName(long), PATH)
    segments = materialise(segments)
    assert segments.count() == 1 + 700 + 19_999
    got = {r.conv_id: r for r in chat.read_back(segments, members, PATH).collect()}
    assert len(got) == 3001 and got[5000].n_turns == 20_000
    assert {r.n_turns for c, r in got.items() if c != 5000} == {2}
    want = "".join(f"{'system' if k % 2 == 0 else 'assistant'}\n{'Be kind.' if k == 0 else f't{k}'}\n" for k in range(20_000))
    assert got[5000].turns_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert got[2999].turns_sha256 == hashlib.sha256(f"system\nBe kind.\nassistant\nanswer {2999 % 700}\n".encode()).hexdigest()


def test_join_of_uneven_keys(spark):
    from boardlake.llm.common import join_uneven

    many = spark.createDataFrame([(1, i) for i in range(500)] + [(k, 0) for k in range(2, 90)] + [(None, 7)], "k int, x int")
    few = spark.createDataFrame([(1, "a"), (1, "b"), (5, "c"), (200, "d"), (None, "e")], "k int, y string")
    got = sorted(map(tuple, join_uneven(many, few, "k", ["x"], least=10).collect()))
    assert got == sorted(map(tuple, many.join(few, "k").collect())) and len(got) == 1001


def test_escape_is_reversible():
    for s in ("", "\\", "<|end|>", "\\l<[\\b", "[INST]\n", "\\\\n"):
        assert chat.unescape(chat.escape(s)) == s
        assert chat.unescape(chat.escape(s, True)) == s
        assert "<" not in chat.escape(s) and "[" not in chat.escape(s)


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    segments, members = chat.format_chat(df, PATH)
    assert segments.count() == 0 and chat.read_back(segments, members, PATH).count() == 0
