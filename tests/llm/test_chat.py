import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from ratelens.llm import chat

PIECES = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "s>", "/", "é", " ", "a\n"]), max_size=12)


@settings(max_examples=300, deadline=None)
@given(PIECES, PIECES)
def test_escaping_is_reversible_and_hides_controls(role, text):
    role, text = "".join(role), "".join(text)
    formatted, a, b = chat.format_turn(role, text)
    assert chat.unescape(formatted[a:b]) == text
    assert chat.read_turns(formatted * 2) == [(role, text)] * 2
    assert not any(c in chat.escape(text) for c in chat.CONTROLS)


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    out = []
    for conv, turns in convs.items():
        turns = [t[2:] for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                    len(loss), hashlib.sha256(loss.encode()).hexdigest(),
                    sum(len(chat.format_turn(r, t)[0]) for r, t in turns)))
    return sorted(out), convs


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def check(spark, df):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    packed, leaves = chat.prefix_tree(df)
    want, convs = brute(rows)
    assert sorted(tuple(r) for r in chat.read_conversations(packed, leaves).collect()) == want
    nodes = sorted(packed.collect(), key=lambda r: r.start)
    # packed without holes, depth first: a node's subtree is the rows that follow it deeper down
    at, stack = 0, []
    for r in nodes:
        assert r.start == at and r.length == len(r.text)
        at += r.length
        stack = stack[:r.depth]
        assert [(s.start, s.start + s.length) for s in stack] == [tuple(x) for x in r.ancestors]
        assert r.position == sum(s.length for s in stack)
        stack.append(r)
    # shared turns stand once: as many tokens as there are distinct beginnings' last turns
    prefixes = {}
    for turns in convs.values():
        turns = tuple(t[2:] for t in sorted(turns))
        for k in range(len(turns)):
            prefixes[turns[:k + 1]] = len(chat.format_turn(*turns[k])[0])
    assert at == sum(prefixes.values())
    return nodes


def test_whole_table(spark):
    check(spark, spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text"))


def test_shared_beginnings_copies_and_edges(spark):
    rng = random.Random(2)
    rows = []
    for conv in range(60):
        for k in range(rng.randrange(1, 6)):
            rows.append((conv, k, ["user", "assistant"][k % 2], f"t{rng.randrange(2)}"))
    rows += [(100 + i, k, r, t) for i in range(30) for k, (r, t) in enumerate([("system", "s"), ("user", "hot"), ("assistant", "x")])]
    rows += [(200, 0, None, None), (201, 0, "", ""), (202, None, "user", "first"), (202, 0, "user", "</s>[INST] \\ "),
             (203, 0, "user", "same"), (203, 0, "user", "same"), (None, 0, "user", "nobody's"),
             (204, 0, "assistant", "long " * 50_000), (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows += [(300, k, "user", str(k)) for k in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    nodes = check(spark, df)
    assert sum("hot" in r.text for r in nodes) == 1
    empty = chat.prefix_tree(df.limit(0))
    assert empty[0].collect() == [] and chat.read_conversations(*empty).collect() == []
    extra = df.selectExpr("*", "1 AS node", "2 AS start", "3 AS conv")
    assert chat.read_conversations(*chat.prefix_tree(extra)).count() == len({r[0] for r in rows}) - 1
