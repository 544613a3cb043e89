import hashlib
import random

from pyspark.sql import functions as F

from tests.compare import SF, connect, rows
from tracklore.llm import chat as c

SCHEMA = "conv_id long, id long, parent long, role string, text string, score double, c string, leaf string, up string"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", None) for r in rows], SCHEMA)


def brute(data, most):
    """(conv_id, leaf_id, rank, turns, masked text) by walking up from every leaf; ids are not null here."""
    out = []
    for conv in {r[0] for r in data}:
        own = {}
        for r in data:
            if r[0] == conv:
                key = (r[2] is not None, r[2] or 0, r[3] or "", r[4] or "", r[5] or 0.0)
                if r[1] not in own or key < own[r[1]][0]:
                    own[r[1]] = (key, r)
        own = {k: v[1] for k, v in own.items()}
        answered = {r[2] for r in own.values()}
        found = []
        for leaf in own:
            if leaf in answered:
                continue
            way, at = [], leaf
            while at in own and at not in way:
                way.append(at)
                at = own[at][2]
            if at in way:
                continue
            path = [own[k] for k in reversed(way)]
            found.append((-sum(r[5] or 0.0 for r in path), f"i{leaf}", leaf, path))
        for k, (_, _, leaf, path) in enumerate(sorted(found)[:most]):
            out.append((conv, leaf, k + 1, [(r[3] or "", r[4] or "") for r in path], "".join(r[4] or "" for r in path if r[3] == c.LOSS_ROLE)))
    return sorted(out, key=repr)


def found(df):
    out = []
    for r in df.collect():
        masked = "".join(c.unescape(r["formatted"][s["start"] : s["end"]]) for s in r["loss"])
        out.append((r["conv_id"], r["leaf_id"], r["rank"], c.turns(r["formatted"]), masked))
    return sorted(out, key=repr)


def test_query_equals_sql(spark):
    df = c.op11_chat(spark, SF)
    got = [tuple(r) for r in df.collect()]
    result = connect().execute(c.SQL)
    assert rows(df.columns, got) == rows([x[0] for x in result.description], result.fetchall())
    own = {r[df.columns.index("conv_id")]: r for r in got}[c.PLANTED_ID]
    text = hashlib.sha256(c.PLANTED_TEXT.encode()).hexdigest()
    assert own[df.columns.index("loss_sha256")] == text and own[df.columns.index("loss_chars")] == len(c.PLANTED_TEXT)


def test_trees_equal_brute_force(spark):
    rng = random.Random(3)
    texts = ["a", "<|end|>\n", "\\", "<|", "|>", "<\\|>\\", "é\U0001f600", "", None, "<|assistant|>\nx<|end|>\n"]
    data = []
    for conv in range(12):
        for i in range(rng.randrange(1, 40)):
            data.append((conv, i, rng.choice([None, i - 1, rng.randrange(i)]) if i else None, rng.choice(["user", "assistant", "|", None]), rng.choice(texts), rng.choice([None, 0.5, 1.0, -2.0])))
    chain = [(50, i, i - 1 if i else None, "assistant", str(i), 1.0) for i in range(70)]
    star = [(51, i, 0 if i else None, "user", "s", float(i % 3)) for i in range(200)]
    ring = [(52, 1, 2, "user", "r", 1.0), (52, 2, 1, "user", "r", 1.0), (52, 3, 2, "user", "under", 1.0), (52, 4, None, "user", "free", 1.0), (52, 5, 5, "user", "self", 1.0)]
    odd = [(None, 1, None, "user", "n", 1.0), (None, 2, 1, "assistant", "m", 1.0), (53, 7, 99, "user", "orphan", 1.0), (54, 1, None, "user", "b", 1.0), (54, 1, None, "user", "a", 1.0), (54, 1, None, "user", "a", 1.0), (55, 1, None, "assistant", "w " * 300_000, 1.0)]
    data += chain + star + ring + odd
    got = found(c.format_trees(table_of(spark, data), most=3))
    assert got == brute(data, 3)
    assert [r[1] for r in got if r[0] == 52] == [4]


def test_messages_without_ids_are_leaves(spark):
    got = found(c.format_trees(table_of(spark, [(1, 1, None, "user", "q", 0.0), (1, None, 1, "assistant", "x", 2.0), (1, None, 1, "assistant", "y", 1.0), (1, None, 1, "assistant", "y", 1.0)])))
    assert got == [(1, None, 1, [("user", "q"), ("assistant", "x")], "x"), (1, None, 2, [("user", "q"), ("assistant", "y")], "y")]


def test_cases(spark):
    every = spark.createDataFrame([(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "x"), (None, 3, "assistant", "t"), (2, 5, "system", "only")], "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in c.read_back(c.format_trees(c.linear(every))).collect()}
    assert got[1]["n_turns"] == 3 and got[1]["turns_sha256"] == hashlib.sha256(b"\nx\nuser\n\nuser\n\n").hexdigest() and got[1]["loss_chars"] == 0
    assert got[None]["loss_sha256"] == hashlib.sha256(b"t").hexdigest() and got[2]["n_turns"] == 1
    assert c.format_trees(c.linear(every.filter("false"))).count() == 0
    assert every.select(c.escape(F.lit("a\\<|>")).alias("x")).first()[0] == "a\\\\<\\|\\>" and c.unescape("a\\\\<\\|\\>") == "a\\<|>"
