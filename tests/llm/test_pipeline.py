import hashlib
import heapq
import math
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as C
from loomstat.llm import packing, tokens
from loomstat.llm.queries import TOKENIZER, toxicity_model
from tests.llm import test_jaccard, test_packing, test_rules, test_toxicity

FOLDER = "/root/testdata/sf0.001"


def plain_quality(docs):
    kept = []
    for d in docs:
        n, chars, symbols, doubles, repeated = test_rules.plain(d["text"])
        lines = sum(bool(test_rules.WORD.search(x)) for x in (d["text"] or "").split("\n"))
        upper, lower = (len(re.findall(c, d["text"] or "")) for c in ("[A-Z]", "[a-z]"))
        base = n < 10 or 100 * repeated > 20 * n
        form = 100 * doubles > 60 * lines or 100 * symbols > 40 * n or 10 * chars < 20 * n or chars > 15 * n or upper > lower
        if not (base or form):
            kept.append(d)
    return kept


def plain_clean(docs, model):
    return [d for d in docs if test_toxicity.plain_score(model, d["text"]) < 0.5]


def plain_distinct(docs):
    groups = {key: least for key, _, least in test_jaccard.plain([(d["doc_id"], d["text"]) for d in docs], 5, 80)}
    return [d for d in docs if groups[d["doc_id"]] == d["doc_id"]]


def plain_mix(docs):
    """Blocks of 16 rows taken slot by slot: of those released, the one with the earliest deadline."""
    rows = defaultdict(list)
    for d in sorted(docs, key=lambda d: hashlib.md5(str(d["doc_id"]).encode()).hexdigest()[:15]):
        rows[d["source"]].append(d)
    names = sorted(rows)
    blocks = {s: [rows[s][i : i + 16] for i in range(0, len(rows[s]), 16)] for s in names}
    root = {s: math.sqrt(len(rows[s])) for s in names}
    total = sum(root.values())
    resolution = max(1000, math.ceil(10 * total / min(root.values())))
    parts = {s: max(1, round(root[s] / total * resolution)) for s in names}
    out = []
    while blocks:  # anew whenever a source has run out
        whole, t, taken = sum(parts[s] for s in blocks), 0, Counter()
        while all(taken[s] < len(own) for s, own in blocks.items()):
            ready = [(-(-(taken[s] + 1) * whole // parts[s]), s) for s in names if s in blocks and taken[s] * whole // parts[s] <= t]
            s = heapq.nsmallest(1, ready)[0][1]
            out += blocks[s][taken[s]]
            taken[s] += 1
            t += 1
        blocks = {s: own[taken[s] :] for s, own in blocks.items() if own[taken[s] :]}
    return out


def plain_sequences(files):
    """Every file a group: whole texts encoded, cut, and each piece tried in every open sequence."""
    encode = tokens.encoding(tokens.Vocabulary.read(TOKENIZER)).encode_ordinary
    longest, found = max(packing.CAPACITIES), set()
    for name, docs in files.items():
        cut = []
        for d in docs:
            n = len(encode(d["text"]))
            cut += [(d["doc_id"], k, longest * k, min(longest, n - longest * k)) for k in range(max(1, -(-n // longest)))]
        place, final = test_packing.plain_fit([c[3] for c in cut], sorted(packing.CAPACITIES), packing.sequence_cost)
        group = re.match(r"part-(\d+)", name).group(1) + "/0"
        for at, c in enumerate(cut):
            b, offset = place[at]
            found.add((*c, f"{group}-{b}", final[b], offset))
    return found


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Per stage its input's rows, the files they stand in, and its result's rows."""
    docs, done = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in C.STAGES:
        given = docs.select("*", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index").collect()
        path = str(tmp_path_factory.mktemp("stages") / name)
        out = stage(spark, docs, FOLDER)
        ordered = out.collect()
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        done[name] = given, ordered, docs
    return done


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_every_stage_equals_its_plain_version(spark, stages):
    given, found, _ = stages["quality"]
    assert ids(found) == ids(plain_quality(given)) and len(found) < len(given)
    given, found, _ = stages["toxicity"]
    docs = stages["quality"][2]
    model = toxicity_model(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert ids(found) == ids(plain_clean(given, model))
    given, found, _ = stages["near-duplicates"]
    assert ids(found) == ids(plain_distinct(given)) and len(found) < len(given)
    given, found, _ = stages["mixing"]
    assert [r["doc_id"] for r in found] == [d["doc_id"] for d in plain_mix(given)]
    given, found, _ = stages["packing"]
    files = defaultdict(list)
    for d in given:
        files[d["file_name"]].append(d)
    assert {tuple(r) for r in found} == plain_sequences(files)


def test_stages_take_effect_and_keep_columns(spark, stages):
    columns, before = None, None
    for name, (given, found, docs) in stages.items():
        assert docs.count() == len(found)
        if name != C.STAGES[-1][0]:
            columns = columns or spark.read.parquet(f"{FOLDER}/documents.parquet").columns
            assert docs.columns == columns
            if before is not None:
                assert docs.exceptAll(before).count() == 0
            before = docs
    encode = tokens.encoding(tokens.Vocabulary.read(TOKENIZER)).encode_ordinary
    given, found, _ = stages["packing"]
    packed = Counter()
    for r in found:
        packed[r["doc_id"]] += r["length"]
    assert packed == Counter({d["doc_id"]: len(encode(d["text"])) for d in given})


def test_stages_survive_odd_and_no_rows(spark, odd, none):
    for _, stage in C.STAGES:
        for rows in (odd, none):
            found = stage(spark, rows, FOLDER)
            assert found.count() <= 1000
            if stage is not C.sequences:
                assert found.columns == rows.columns
