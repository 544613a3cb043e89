import random

from pyspark.sql import functions as F

from tests.compare import SF
from tracklore.llm import token_count as t

PIECES = ["a", "B", "é", "'", " ", "  ", "\n", "9", "!", "'ll", "the", " \t", "ß", "12", "...", "'r", "e"]


def test_edits_equal_a_new_count():
    counts = t.PieceCounts(t.tokenizer_file())
    r = random.Random(3)
    for _ in range(1500):
        text = "".join(r.choice(PIECES) for _ in range(r.choice([0, 1, 5, 40, 400])))
        at = sorted(r.randint(0, len(text)) for _ in range(2 * r.choice([1, 1, 2, 5])))
        edits = [(at[2 * i], at[2 * i + 1], "".join(r.choice(PIECES) for _ in range(r.choice([0, 0, 1, 3])))) for i in range(len(at) // 2)]
        tree = t.TokenTree.of(text, counts)
        new = tree.edit(text, edits, counts)
        want = t.TokenTree.of(new, counts)
        assert [list(x) for x in tree.leaves()] == [list(x) for x in want.leaves()]
        assert tree.total == want.total == len(counts.encoding.encode_ordinary(new)) and tree.length == len(new)


def test_only_the_edited_region_is_recoded():
    counts = t.PieceCounts(t.tokenizer_file())
    text = "some words and more " * 5000
    tree = t.TokenTree.of(text, counts)
    tree.edit(text, [(50_000, 50_004, "x")], counts)
    assert tree.recoded < 10


def test_stored_trees_are_edited(spark):
    ranks = t.tokenizer_file()
    docs = spark.createDataFrame([(1, "call 12345 now"), (2, None), (3, ""), (None, "x y")], "doc_id long, text string")
    trees = t.build_trees(docs.withColumn("n_tokens", F.lit("extra")), ranks)
    rows = docs.filter("doc_id = 1").join(trees, "doc_id").withColumn("edits", F.expr("array(named_struct('start', 5, 'end', 10, 'text', '<n>'))"))
    got = t.apply_edits(rows, ranks).first()
    assert got["text"] == "call <n> now" and got["n_tokens"] == len(t.PieceCounts(ranks).encoding.encode_ordinary("call <n> now"))
    assert {r["doc_id"]: r["n_tokens"] for r in trees.collect()}[2] == 0
    assert t.count_before_and_after(docs.filter("false"), ranks).count() == 0


def test_query_against_plain_counts(spark):
    """Both counts of the query, by encoding the text and the masked text whole."""
    import tiktoken

    from tests.llm.test_pii import plain

    encode = t.PieceCounts(t.tokenizer_file()).encoding.encode_ordinary
    assert isinstance(t.PieceCounts(t.tokenizer_file()).encoding, tiktoken.Encoding)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in t.op1_token_count(spark, SF).collect()}
    assert got.keys() == {d["doc_id"] for d in docs}
    for d in docs:
        text = d["text"] or ""
        parts, at, edits = [], 0, 0
        for kind, s, e in sorted(plain(text), key=lambda x: (x[1], -x[2])):
            if s >= at:
                parts += [text[at:s], f"<{kind}>"]
                at, edits = e, edits + 1
        r = got[d["doc_id"]]
        assert (r["n_chars"], r["n_tokens"], r["n_edits"], r["n_tokens_after"]) == (len(text), len(encode(text)), edits, len(encode("".join([*parts, text[at:]]))))


def test_repeats_nulls_and_clashing_columns(spark):
    rows = [(1, "mail a@b.org now", 5), (1, "mail a@b.org now", 5), (None, "x", 1), (2, None, 0), (3, "", 0), (4, "word " * 200_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = t.count_before_and_after(docs, t.tokenizer_file()).collect()
    assert len(got) == 6 and [r["n_tokens"] for r in got if r["doc_id"] in (2, 3)] == [0, 0]
    assert len({(r["n_tokens"], r["n_tokens_after"]) for r in got if r["doc_id"] == 1}) == 1
    assert [r["n_tokens"] for r in got if r["doc_id"] == 4][0] >= 200_000
