from loomstat.llm import preference as P

SHAPE = "pair_id string, turn long, role string, text string, n long, part string, side string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SHAPE)


def test_longest_common_prefix_and_spans(spark):
    chosen = [("p", 0, "user", "hi"), ("p", 1, "assistant", "hello"), ("p", 2, "user", "how"), ("p", 3, "assistant", "fine"), ("p", 4, "user", "ok"), ("p", 5, "assistant", "bye")]
    rejected = [*chosen[:3], ("p", 3, "assistant", "bad"), ("p", 4, "user", "ok")]
    same = [("q", 0, "user", None), ("q", 1, None, "x")]
    more = [("r", 0, "user", "a"), ("r", 1, "assistant", "b")]
    left = table(spark, [*chosen, *same, *more, ("only", 0, "assistant", "z"), (None, 0, "user", "lost")])
    right = table(spark, [*rejected, *same, *more[:1]])
    found = {r["pair_id"]: r for r in P.preference_pairs(left, right).collect()}
    assert set(found) == {"p", "q", "r", "only"}
    p = found["p"]
    assert p["n_shared"] == 3 and p["prompt"].count("<|end|>") == 3
    assert p["chosen"] == "<|assistant|>\nfine<|end|>\n<|user|>\nok<|end|>\n<|assistant|>\nbye<|end|>\n"
    parts = [p["chosen"][s["start"] : s["end"]] for s in p["chosen_spans"]]
    assert parts == ["<|assistant|>\nfine<|end|>\n", "<|assistant|>\nbye<|end|>\n"]
    assert [p["rejected"][s["start"] : s["end"]] for s in p["rejected_spans"]] == ["<|assistant|>\nbad<|end|>\n"]
    assert found["q"]["n_shared"] == 2 and found["q"]["chosen"] == found["q"]["rejected"] == ""
    assert found["r"]["n_shared"] == 1 and found["r"]["rejected"] == "" and found["r"]["rejected_spans"] == []
    assert found["only"]["prompt"] == "" and len(found["only"]["chosen_spans"]) == 1


def test_repeated_turns_and_empty_tables(spark):
    twice = table(spark, [("p", 0, "user", "a"), ("p", 0, "user", "a"), ("p", None, "user", "first")])
    row = P.preference_pairs(twice, twice).first()
    assert row["n_shared"] == 3 and row["prompt"].startswith("<|user|>\nfirst")
    none = table(spark, [])
    assert P.preference_pairs(none, none).collect() == []


def test_foreign_endings_differ_in_the_last_answer_only(spark):
    rows = [(f"{i}", t, ("user", "assistant")[t % 2], f"{i}-{t}") for i in range(5) for t in range(3)]
    chosen, rejected = P.with_foreign_endings(table(spark, rows), pair="pair_id", bucket=2)
    found = P.preference_pairs(chosen, rejected).collect()
    assert len(found) == 5 and all(r["n_shared"] == 1 and r["chosen"] != r["rejected"] for r in found)
    assert sorted(r["chosen"] for r in found) == sorted(r["rejected"] for r in found)


def test_very_long_texts_and_very_many_turns(spark):
    rows = [("long", 0, "user", "x" * 3_000_000), ("long", 1, "assistant", "y" * 2_000_000)]
    many = [("many", t, ("user", "assistant")[t % 2], f"turn {t}") for t in range(20_000)]
    chosen = table(spark, [*rows, *many])
    rejected = table(spark, [*rows[:1], ("long", 1, "assistant", "z"), *many[:1], *[(p, t, r, x + "!") for p, t, r, x in many[1:]]])
    found = {r["pair_id"]: r for r in P.preference_pairs(chosen, rejected).collect()}
    assert found["long"]["n_shared"] == 1 and len(found["long"]["chosen"]) == 2_000_000 + len("<|assistant|>\n<|end|>\n")
    r = found["many"]
    assert r["n_shared"] == 1 and len(r["chosen_spans"]) == len(r["rejected_spans"]) == 10_000
    for s, (_, _, _, text) in list(zip(r["rejected_spans"], many[1::2]))[::997]:
        assert r["rejected"][s["start"] : s["end"]] == f"<|assistant|>\n{text}!<|end|>\n"
