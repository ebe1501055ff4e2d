import re
from collections import Counter

from pyspark.sql import functions as F

from loomstat.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    ws = WORD.findall(text or "")
    grams = [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
    many = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    chars = "".join(ws)
    return len(ws), len(chars), sum(c in "#*$%&|<>" for c in chars), len(lines) - len(set(lines)), len(hit)


def test_measurements_equal_the_plain_way(spark, odd):
    more = ["a b c d e " * 5, "a a a a a a", "x\ny\nx\n \n \nx", "#*$ %&|<> q", "a b c d e f a b c d e g a b c d e", "A\x0bB"]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame([(900 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    rows = rules.ledger(docs, doc_id=F.col("doc_id"), body=F.col("text")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain(r["body"])
        n = r["n_words"]
        assert bool(r["failures"] & rules.BASE.mask) == (n < 10 or 100 * r["n_repeat_words"] > 20 * n)


def test_policies_read_the_bits_alone(spark, none):
    rows = spark.createDataFrame([(b,) for b in (0, 0, 1, 2, 3, 8, 9)], "failures long")
    two = rules.Policy("x", ("few_words", "symbols"))
    assert rows.filter(~rules.rejects(two)).count() == 3
    found = {r["rule"]: r for r in rules.ablation(rows, [two]).collect()}
    assert [found["few_words"][c] for c in ("failed", "only_this", "kept_without")] == [3, 2, 5]
    assert [found["symbols"][c] for c in ("failed", "only_this", "kept_without")] == [2, 1, 4]
    empty = rules.ablation(rules.ledger(none), [rules.BASE, rules.STRICT]).collect()
    assert len(empty) == len(rules.BASE.rules) + len(rules.RULES) and all(r["failed"] == 0 for r in empty)


def test_no_python_and_no_shuffle_in_the_plan(odd):
    plan = rules.ledger(odd, doc_id=F.col("doc_id"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Aggregate" not in plan
