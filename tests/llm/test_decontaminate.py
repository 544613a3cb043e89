import re

from tests.compare import SF
from tracklore.llm import decontaminate as d
from tracklore.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(text, items, n=10):
    w, hit, found = words(text), set(), set()
    for k, t in items:
        i = words(t)
        for win in [i] if 0 < len(i) < n else [i[a : a + n] for a in range(len(i) - n + 1)]:
            for a in range(len(w) - len(win) + 1):
                if w[a : a + len(win)] == win:
                    hit |= set(range(a, a + len(win)))
                    found |= {k} - {None}
    return len(w), sorted(hit), sorted(found)


def test_small_cases_against_brute_force(spark):
    long = " ".join(f"w{i}" for i in range(30))
    items = [(1, "Short Item"), (2, long), (3, None), (4, ""), (2, "w3 w4"), (None, "zz zz")]
    docs = [(1, "a SHORT-item. short item"), (2, "x " + long[3:] + " y"), (3, None), (4, ""), (5, "Ünï short"), (1, "zz zz w3 w4"), (None, "short item"), (6, " ".join(f"w{i}" for i in range(5, 14)))]
    got = d.find_contamination(spark.createDataFrame([(*r, 9) for r in docs], "doc_id long, text string, items int"), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = sorted((r[0] or -1, *brute(r[1], items)) for r in docs)
    assert sorted((r["doc_id"] or -1, r["n_words"], r["hit_words"], r["items"]) for r in got) == want
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in got if r["doc_id"] == 2}
    assert spans[2] == [(2, 2 + len(long) - 3)]


def test_query_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    want = {r["doc_id"]: brute(r["text"], items) for r in docs.collect()}
    for r in d.op3_decontaminate(spark, SF).collect():
        n, hit, found = want[r["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, len(hit), len(found), bool(hit))


def test_large_item_tables_are_dealt_into_parts(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, "three four"), (2, "three four"), (3, "five")], "doc_id long, text string")
    items = spark.createDataFrame([(i, t) for i, t in enumerate(["one two", "three", "four", "six"])], "item_id long, text string")
    whole, parts = (sorted((r["doc_id"], r["n_words"], r["hit_words"], r["items"]) for r in d.find_contamination(docs, items, max_item_chars=m).collect()) for m in (10**6, 5))
    assert whole == parts
    assert d.drop_contaminated(docs, items).count() == 1 and d.find_contamination(docs, items.filter("false")).count() == 4


def test_parts_give_the_same_spans(spark):
    long = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, f"x {long} y"), (2, "Ünï " + long[:60]), (None, long), (2, "w1 w2"), (3, None), (4, "")], "doc_id long, text string")
    items = spark.createDataFrame([(9, long), (8, long[20:90]), (7, "ünï w0"), (None, "w1 w2")], "item_id long, text string")
    whole, parts = (sorted(map(repr, d.find_contamination(docs, items, max_item_chars=m).collect())) for m in (10**6, 60))
    assert whole == parts
    assert [(s["start"], s["end"]) for r in d.find_contamination(docs, items, max_item_chars=60).filter("doc_id = 1").collect() for s in r["spans"]] == [(2, 2 + len(long))]


def test_dropping_is_the_same_in_parts(spark):
    rows = [(1, "one two", 7), (1, "clean text", 8), (None, "six", 9), (None, "seven", 10), (2, None, 11), (3, "four five", 12), (4, "", 13), (4, "", 13)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int")
    items = spark.createDataFrame([(i, t) for i, t in enumerate(["one two", "three", "four", "six", None])], "item_id long, text string")
    for bound in (10**6, 5):
        got = d.drop_contaminated(docs, items, max_item_chars=bound)
        assert got.columns == docs.columns and sorted(r["y"] for r in got.collect()) == [8, 10, 11, 13, 13]


def test_an_automaton_at_the_bound_fits_in_memory():
    """In a process of its own: the memory that the largest automaton takes."""
    import subprocess
    import sys

    code = """
import random
from tracklore.llm.decontaminate import MAX_ITEM_CHARS, Scanner
r = random.Random(1)
vocabulary = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randrange(2, 11))) for _ in range(50_000)]
items, chars = [], 0
while chars < MAX_ITEM_CHARS:
    items.append((len(items), " ".join(r.choices(vocabulary, k=60))))
    chars += len(items[-1][1])
resident = lambda: int(open("/proc/self/statm").read().split()[1]) * 4096
before = resident()
scanner = Scanner(items, 10)
assert scanner.scan("x " + items[7][1] + " y")[2] == [7]
print((resident() - before) / 1e6)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=str(__import__("pathlib").Path(__file__).parents[2]), check=True)
    assert float(out.stdout) < 300


def test_very_long_texts(spark):
    items = [(1, " ".join(f"k{i}" for i in range(12))), (2, "lone pair")]
    text = "filler word " * 150_000 + items[0][1] + " more" * 200_000 + " lone pair"
    got = d.find_contamination(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).first()
    assert (got["n_words"], got["items"], len(got["hit_words"])) == (500_014, [1, 2], 14)
    assert [text[s["start"] : s["end"]] for s in got["spans"]] == [items[0][1], "lone pair"]
