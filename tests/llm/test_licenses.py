import random

from loomstat.llm import licenses as L


def test_alignment_is_a_common_subsequence():
    rng = random.Random(2)
    for _ in range(300):
        a = [rng.choice("abcdefghij") for _ in range(rng.randrange(30))]
        b = list(a) if rng.random() < 0.3 else [rng.choice("abcdefghij") for _ in range(rng.randrange(30))]
        pairs = L.align(a, b)
        assert all(a[i] == b[k] for i, k in pairs)
        assert all(x < y and p < q for (x, p), (y, q) in zip(pairs, pairs[1:]))
        if a == b:
            assert len(pairs) == len(a)


def test_rising_runs_are_longest():
    rng = random.Random(4)
    for _ in range(200):
        places = rng.sample(range(20), rng.randrange(9))
        best = 0
        for bits in range(1 << len(places)):
            run = [p for n, p in enumerate(places) if bits >> n & 1]
            if run == sorted(run):
                best = max(best, len(run))
        assert len(L._rising(list(enumerate(places)))) == best


def test_every_template_is_found_whole_and_damaged():
    scanner = L.Scanner()
    for name, text in L.TEMPLATES.items():
        body = f"Some words before.\n{text}\nand some words after it, too."
        top = scanner.scan(body)[0]
        assert top.license == name and top.coverage == 1.0 and body[top.start : top.end] == text.rstrip(".)/")
        if len(text) > 200:
            hurt = text.split()
            del hurt[20]
            hurt.insert(7, "extra")
            assert scanner.scan(" ".join(hurt).upper())[0].license == name
    assert scanner.scan("The license plate of the car was released under the bridge.") == []
    assert len(scanner.scan((L.TEMPLATES["MIT"] + "\nwords between here and there. " * 3) * 2)) == 2


def test_notices_in_a_row_are_all_found():
    scanner = L.Scanner()
    for name, text in L.TEMPLATES.items():
        size = len(L.WORD.findall(text.lower()))
        for n in (2, 3, 4, 7, 40):
            for head, tail in ((0, size), (size, size), (size, 0), (3 * size, 5 * size)):
                body = "before " * head + (text + " ") * n + "after " * tail
                found = scanner.scan(body)
                assert [m.license for m in found] == [name] * n and all(m.coverage == 1 for m in found)
        if size > 30:
            hurt = text.split()
            del hurt[20]
            hurt.insert(7, "extra")
            assert len(scanner.scan("before " * size + (" ".join(hurt) + " ") * 5 + "after " * size)) == 5


def test_odd_rows(spark, odd, none):
    extra = spark.createDataFrame([(500, L.TEMPLATES["GPL-3.0"].lower())], "doc_id long, text string")
    rows = L.scan(odd.select("doc_id", "text").union(extra)).collect()
    assert len(rows) == odd.count() + 1
    assert [(r["doc_id"], r["matches"][0]["license"]) for r in rows if r["matches"]] == [(500, "GPL-3.0")]
    assert L.scan(odd).count() == odd.count() and L.scan(none).collect() == []


def common(a, b):
    """Length of the longest common subsequence, by the full table."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for k, y in enumerate(b):
            row.append(last[k] + 1 if x == y else max(row[-1], last[k + 1]))
    return row[-1]


def test_alignment_is_longest_where_words_occur_once_and_never_longer():
    rng = random.Random(11)
    for _ in range(300):
        a, b = (rng.sample(range(25), rng.randrange(20)) for _ in range(2))
        assert len(L.align(a, b)) == common(a, b)
        a, b = ([rng.randrange(8) for _ in range(rng.randrange(25))] for _ in range(2))
        assert len(L.align(a, b)) <= common(a, b)


def test_scan_equals_trying_every_window():
    """Templates and texts whose words occur once: a window's coverage is its longest common subsequence."""
    rng = random.Random(12)
    templates = {name: [f"{name}{i}" for i in range(n)] for name, n in (("aa", 10), ("bb", 15), ("cc", 20))}
    scanner = L.Scanner({name: " ".join(ws) for name, ws in templates.items()})
    some = none = 0
    for _ in range(250):
        text = [f"z{i}" for i in range(rng.randrange(40))]
        for name, ws in templates.items():
            part = [w for w in ws if rng.random() < rng.choice([0.6, 0.9])]
            for _ in range(rng.randrange(4)):
                part.insert(rng.randrange(len(part) + 1), f"y{rng.randrange(10**9)}")
            if rng.random() < 0.3:
                rng.shuffle(part)
            if rng.random() < 0.7:
                at = rng.randrange(len(text) + 1)
                if not any(w[:2] in templates for w in text[max(0, at - 1) : at + 1]):
                    text[at:at] = part
        body = " ".join(text)
        found = {m.license: m for m in scanner.scan(body)}
        for name, ws in templates.items():
            size = len(ws)
            windows = (text[i : i + n] for n in range(1, int(1.25 * size) + 1) for i in range(len(text) - n + 1))
            best = max((common(ws, w) for w in windows if sum(x.startswith(name) for x in w) >= 0.8 * size), default=0)
            if best >= 0.8 * size:
                some += 1
                m = found[name]
                assert m.coverage * size >= best - 1e-9
                assert common(ws, body[m.start : m.end].split()) == round(m.coverage * size)
            elif name in found:
                m = found[name]
                assert common(ws, body[m.start : m.end].split()) == round(m.coverage * size) >= 0.8 * size
            else:
                none += 1
    assert some > 50 and none > 50
