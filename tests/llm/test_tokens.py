import random

import pytest
from pyspark.sql import functions as F

from loomstat.llm import tokens as K

PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def vocabulary():
    return K.Vocabulary.read(PATH)


def test_edits_equal_encoding_the_whole_text(vocabulary):
    enc, rng = K.encoding(vocabulary), random.Random(6)
    for _ in range(400):
        letters = " \n\tab'1é.\x1c "
        text = "".join(rng.choice(letters) for _ in range(rng.choice([0, 3, 700, 3000])))
        if rng.random() < 0.5:
            text = " ".join(f"word{rng.randrange(50)}" for _ in range(rng.randrange(600)))
        tree = K.TokenTree.build(text, enc)
        assert tree.total == len(enc.encode_ordinary(text)) and tree.length[1] == len(text)
        edits = []
        for _ in range(rng.randrange(1, 5)):
            at = rng.randrange(len(text) + 1)
            edits.append((at, at + rng.choice([0, 1, 3, 700]), "".join(rng.choice(letters) for _ in range(rng.randrange(6)))))
        after, _ = K.apply_edits(tree, text, edits, enc)
        assert tree.total == len(enc.encode_ordinary(after)) and tree.length[1] == len(after)


def test_an_edit_encodes_its_surroundings_only(vocabulary):
    enc = K.encoding(vocabulary)
    text = " ".join(f"word{i}" for i in range(20_000))
    tree = K.TokenTree.build(text, enc)
    _, encoded = K.apply_edits(tree, text, [(70_000, 70_003, "new")], enc)
    assert encoded < 4 * K.LEAF_CHARS


def test_odd_rows_and_masked_addresses(spark, odd, none, vocabulary):
    extra = spark.createDataFrame([(500, "write to 𝔘 me.x@mail.org or 1.2.3.4, é"), (501, "a@b.c a@b.c")], "doc_id long, text string")
    docs = odd.select("doc_id", "text").union(extra)
    edits = K.replacements("text", r"[a-z.]+@[a-z.]+|[0-9]+(?:\.[0-9]+){3}", "[x]")
    enc = K.encoding(vocabulary)
    rows = K.edited_counts(K.token_trees(docs, vocabulary), vocabulary, edits).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["n_tokens_edited"] == len(enc.encode_ordinary(r["text_edited"] or ""))
    found = {r["doc_id"]: r for r in rows}
    assert found[500]["text_edited"] == "write to 𝔘 [x] or [x], é" and found[501]["text_edited"] == "[x] [x]"
    assert found[1]["n_tokens"] == 0
    assert K.edited_counts(K.token_trees(none, vocabulary), vocabulary, F.lit(None).cast("array<struct<start:int,end:int,new:string>>")).collect() == []
