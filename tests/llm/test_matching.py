"""Near-duplicates, decontamination, personal data and secrets against brute force."""

import random
import re

import numpy as np
import pytest
from logquarry.llm import near_dedup, queries
from logquarry.llm.common import stored
from logquarry.llm.decontaminate import contaminated, decontaminate, infix_distance, passages
from logquarry.llm.near_dedup import components, near_duplicates
from logquarry.llm.personal_data import BASE, automaton, iban, luhn, personal_data, spans
from logquarry.llm.secrets import Forest, features, candidates, labelled_findings, scan, train

from .conftest import SF


def plain_components(texts):
    sets = {}
    for i, text in texts.items():
        lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        words = re.findall("[^\x20\x09-\x0d]+", lowered)
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
    above = {i: i for i in sets}

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = root(i), root(j)
                above[max(a, b)] = min(a, b)
    return {i: (i, len(sets[i]), root(i), root(i) == i) for i in sets}


def test_a_dense_group_of_near_misses(spark, monkeypatch):
    """Hundreds of texts that are nearly similar enough to each other, and some that are: no link is lost, and
    hardly more pairs than links pass the check."""
    draw = random.Random(12)
    base = [f"w{i}" for i in range(160)]

    def changed(words, n):
        words = list(words)
        for i in draw.sample(range(len(words) // 8), n):
            words[8 * i + draw.randrange(3)] = f"x{draw.random()}"
        return words

    texts = {i: " ".join(changed(base, 4)) for i in range(300)}
    texts |= {300 + i: " ".join(changed(texts[7 * i].split(), 1)) for i in range(20)}
    counted = []
    kept = near_dedup.agreeing

    def counting(pairs, least):
        passed = stored(kept(pairs, least), "passed")
        counted.append((pairs.count(), passed.count()))
        return passed

    monkeypatch.setattr(near_dedup, "agreeing", counting)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = near_duplicates(frame).collect()
    assert {r.doc_id: tuple(r) for r in rows} == plain_components(texts)
    assert len({r.component_id for r in rows}) > 100  # the group doesn't fall into one
    shingles = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for t in texts.values())]
    similar = [len(x & y) / len(x | y) for i, x in enumerate(shingles) for y in shingles[:i]]
    assert sum(0.55 < s < 0.75 for s in similar) > 10_000
    assert sum(p for p, _ in counted) < 10 * len(texts) and sum(n for _, n in counted) < 3 * len(texts)


def test_bits_rule_out_no_link():
    draw = random.Random(2)
    for _ in range(400):
        x = {draw.getrandbits(64) for _ in range(draw.randrange(1, 300))}
        y = set(draw.sample(sorted(x), draw.randrange(len(x) + 1))) | {draw.getrandbits(64) for _ in range(draw.randrange(60))}
        if y:
            bits = [near_dedup.marked(np.array(sorted(s), np.uint64)) for s in (x, y)]
            common = len(x & y)
            if 100 * common >= 75 * (len(x) + len(y) - common):
                assert near_dedup.may_link(bits[0], len(x), bits[1], len(y)) and near_dedup.may_link(bits[1], len(y), bits[0], len(x))
    x, y = (np.array([draw.getrandbits(64) for _ in range(200)], np.uint64) for _ in "xy")
    assert not near_dedup.may_link(near_dedup.marked(x), 200, near_dedup.marked(y), 200)


def test_near_duplicates(spark, texts):
    rows = queries.QUERIES["op9_near_duplicates"](spark, SF).collect()
    assert {tuple(r) for r in rows} == set(plain_components(texts).values())


def test_near_duplicate_groups(frame):
    draw = random.Random(4)
    base = [draw.choice(["ab", "cd", "ef", "gh", "ij", "kl"]) + str(draw.randrange(40)) for _ in range(120)]
    rows = {}
    for i in range(120):  # near copies of one text, some close to others only, and a chain of drifting ones
        words = base[:]
        for _ in range(draw.randrange(6)):
            words[draw.randrange(len(words))] = f"new{draw.randrange(9)}"
        rows[i] = " ".join(words)
    words = [f"w{k}" for k in range(100)]
    for i in range(120, 160):
        words = words[3:] + [f"v{i}-{k}" for k in range(3)]
        rows[i] = " ".join(words)
    rows |= {200: "", 201: None, 202: " \n ", 203: "one two", 204: "ONE\ttwo", 205: "one two three", 206: "É é", 207: "é é"}
    given = [*rows.items(), (203, "one two"), (None, "one two")]
    found = near_duplicates(frame(given, ", kept int, component_id int")).collect()
    assert len(found) == len(given)
    assert {tuple(r) for r in found} == {*plain_components(rows).values(), (None, 1, None, True)}


def test_stars(spark):
    draw = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 130)] + [(draw.randrange(200, 300), draw.randrange(200, 300)) for _ in range(60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    least = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in least:
        for a, b in edges:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    assert got == least


def edited(words, n, pool, draw):
    words = words[:]
    for _ in range(n):
        at, kind = draw.randrange(len(words)), draw.random()
        if kind < 0.4:
            words[at] = draw.choice(pool)
        elif kind < 0.7:
            words.insert(at, draw.choice(pool))
        else:
            del words[at]
    return words


def plain_distance(item, words):
    row = list(range(len(item) + 1))
    best = row[-1]
    for word in words:
        above, row[0] = 0, 0
        for i, own in enumerate(item, 1):
            above, row[i] = row[i], min(above + (own != word), row[i] + 1, row[i - 1] + 1)
        best = min(best, row[-1])
    return best


def test_infix_distance():
    draw = random.Random(2)
    for _ in range(400):
        item = [draw.randrange(4) for _ in range(draw.randint(1, 9))]
        words = [draw.randrange(4) for _ in range(draw.randint(0, 14))]
        assert infix_distance(item, words)[0] == plain_distance(item, words)


def test_decontamination(spark, documents, texts, frame):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r.item_id: r.text for r in benchmark.collect()}
    exact = {i for i, text in texts.items() if any(x in text for x in items.values())}
    found = {r.doc_id: r for r in contaminated(documents, benchmark).collect()}
    assert exact <= set(found)
    normal = {i: [y for x in t.lower().split() if (y := "".join(filter(str.isalnum, x)))] for i, t in (texts | {}).items()}
    wanted = {i: [y for x in t.lower().split() if (y := "".join(filter(str.isalnum, x)))] for i, t in items.items()}
    for i, row in found.items():
        for item in row["items"]:
            assert plain_distance(wanted[item], normal[i]) <= 0.2 * len(wanted[item])
    kept = decontaminate(documents, benchmark)
    assert kept.columns == documents.columns and {r.doc_id for r in kept.collect()} == set(texts) - set(found)

    draw = random.Random(3)
    pool = [w for t in list(texts.values())[:50] for w in t.split()]
    clean = [texts[i] for i in sorted(set(texts) - set(found))]
    rows = []
    for k in range(200):
        item = k % len(items)
        own = edited(items[item].split(), int(0.2 * len(wanted[item])) * (k % 3) // 2, pool, draw)
        host = clean[k % len(clean)].split()
        at = draw.randrange(len(host))
        rows.append((k, " ".join([*host[:at], *own, *host[at:]])))
    got = {(r.doc_id, r.item_id) for r in passages(frame(rows), benchmark).collect()}
    assert sum((k, k % len(items)) in got for k, _ in rows) >= 0.95 * len(rows)
    odd = frame([(1, None), (2, ""), (None, items[0]), (3, items[0]), (3, items[0])], ", item_id int, edits int")
    assert sorted((r.doc_id or 0, r.n_passages) for r in contaminated(odd, benchmark).collect()) == [(0, 1), (3, 2)]
    assert decontaminate(odd, benchmark).count() == 2
    assert contaminated(odd, benchmark.limit(0)).count() == 0 and contaminated(odd.limit(0), benchmark).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match[0])
            if kind == "ip" and any(int(x) > 255 for x in match[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            found.append((kind, *match.span()))
    return found


def test_base_spans():
    draw, anchors = random.Random(1), automaton()
    parts = ["@", ".", "-", "+", " ", "(", ")", "1", "2", "55", "0", "255", "a", "b.c", "é", "x@y.z", "4111111111111111", "%", "1.2.3.4", "\n"]
    for _ in range(20_000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        assert [x for x in spans(text, anchors) if x[0] in BASE] == plain_spans(text)
    assert spans("7" * 200_000 + "@" * 10_000 + "+1" * 10_000) == plain_spans("7" * 200_000 + "@" * 10_000 + "+1" * 10_000)


def test_added_spans():
    text = "Account no: 12345678, IBAN GB82 WEST 1234 5698 7654 32, https://me:pw@host.org sip:a@b"
    added = [(kind, text[a:b]) for kind, a, b in spans(text) if kind not in BASE]
    assert added == [
        ("account", "12345678"),
        ("account", "GB82 WEST 1234 5698 7654 32"),
        ("address", "me:pw@host.org"),
        ("address", "a@b"),
    ]
    assert iban("GB82WEST12345698765432") and not iban("GB82WEST12345698765433")


def test_personal_data(documents, texts, frame):
    import hashlib

    for row in personal_data(documents).collect():
        base = plain_spans(texts[row.doc_id])
        assert [row[f"n_{k}"] for k in BASE] == [sum(x[0] == k for x in base) for k in BASE]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
    rows = personal_data(frame([(1, None), (1, ""), (None, "é a@b.cd")], ", spans int, found int")).collect()
    assert sorted(r.spans for r in rows) == ["", "", "email:2:8"]
    assert personal_data(frame([])).count() == 0


def test_secrets(documents, texts, frame):
    found = scan(documents).collect()
    assert all(texts[r.doc_id][r.start : r.stop] == r.secret for r in found)
    run = r"(?<![A-Za-z0-9_+/=~-])(?=[A-Za-z_+/=~-]*[0-9])[A-Za-z0-9_+/=~-]{16,}"
    assert len(found) == sum(len(re.findall(run, t)) for t in texts.values())
    odd = ["", None, 'é token = "abcdef0123456789abcd" x', "number 1234567890123456 1234567890123457"]
    rows = scan(frame([(i, x) for i, x in enumerate(odd)] * 2, ", secret int, label int")).collect()
    assert sorted((r.doc_id, r.start, r.is_secret) for r in rows) == sorted([(2, 11, True), (3, 7, False), (3, 24, False)] * 2)
    assert scan(frame([])).count() == 0
    assert [r.is_secret for r in scan(frame([(1, "password: abcdefgh12345678")])).collect()] == [True]


def test_names_inside_runs(frame):
    key = "9f8e7d6c5b4a39281706f5e4"
    texts = {
        f"API_KEY={key}": "API_KEY",
        f"export AWS_SECRET_ACCESS_KEY={key}== x": "AWS_SECRET_ACCESS_KEY",
        f"https://a.org/b?page=2&token={key}&x=1": "token",
        f"https://a.org/b?token={key}": "token",
        f"--auth-token={key}": "--auth-token",
        f"/api/v1/token={key}": "token",
        f"app:\n  api_key: {key}\n": "api_key",
        f"app:\n  api_key:{key}\n": "api_key",
        f"in prose {key}= alone": "",
    }
    rows = scan(frame([*enumerate(texts)])).collect()
    named = {r.doc_id: r for r in rows if r.secret.rstrip("=") == key}
    assert {i: named[i].path for i in named} == dict(enumerate(texts.values()))
    for i, text in enumerate(texts):
        assert text[named[i].start : named[i].stop] == named[i].secret
        assert named[i].is_secret == (named[i].path != "")
    assert named[1].secret == key + "==" and named[8].secret == key + "="


def test_assigned_values_of_any_form(frame):
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9P"
    texts = [
        ("password: hunter2secret", "hunter2secret"),
        ('my password = "Tr0ub4dor&3xyz!q", and', "Tr0ub4dor&3xyz!q"),
        ("api_key='QwErTyUiOpAsDfGhJkLz'", "QwErTyUiOpAsDfGhJkLz"),
        ('{"password":"a b\\"c","user":"me"}', 'a b\\"c'),
        ("DB_PASSWORD=p&w;d,9!", "p&w;d,9!"),
        ("Server=x;Password=a1;User=b", "a1"),
        ("https://h/api/v1/token=Tr0ub4dor!3&user=x1", "Tr0ub4dor!3"),
        ("The password is (pwd: x7).", "x7"),
        (f"Authorization: Bearer {jwt}", jwt),
        (f"see {jwt}.", jwt),
    ]
    rows = scan(frame([(i, x) for i, (x, _) in enumerate(texts)])).collect()
    assert sorted((r.doc_id, r.secret) for r in rows) == [(i, x) for i, (_, x) in enumerate(texts)]
    assert all(texts[r.doc_id][0][r.start : r.stop] == r.secret for r in rows)
    assert all(r.path for r in rows if r.doc_id < 9)
    none = ["Author: Jane Doe", 'password = ""', "mail3.example.com and file-12.name.txt", "abcdefghijklmnop..5"]
    assert scan(frame([*enumerate(none)])).count() == 0
    long = ["a.1" * 60_000, "password=" + "a,b" * 60_000, "token = '" + "\\'" * 60_000 + "'", "pwd:" + ")" * 60_000 + "x", "/token1" * 30_000]
    assert sorted(r.doc_id for r in scan(frame([*enumerate(long)])).collect()) == [1, 2, 3, 4]


def test_forest_does_not_repeat_its_labels(frame):
    draw = random.Random(8)
    key = lambda n: "".join(draw.choice("0123456789abcdefghijkmnpqrstuvwxyzABCDEFGHKLMNPQRST") for _ in range(n))
    words = ["your", "sample", "value", "insert", "here", "changeme", "placeholder", "example"]
    rows = []
    for i in range(300):
        rows.append((i, f'call it with token = "{key(draw.randrange(20, 60))}" and pay'))
        rows.append((1000 + i, f"the number {draw.randrange(10**15, 10**draw.randrange(16, 40))} on the card"))
        rows.append((2000 + i, f'set api_key = "{"-".join(draw.choices(words, k=draw.randrange(2, 6)))}" before'))
    plain = ["garden-house-window", "summer_evening_in_town", "nobody-will-ever-remember", "the.quick.brown.fox"]
    rows += [(3000 + i, f"he sent {key(40)} by mail") for i in range(100)]  # no label: assigned to nothing
    rows += [(4000 + i, f'password = "{plain[i % 4]}" it said') for i in range(20)]  # labelled a secret, but reads as none
    rows += [(5000 + i, f"sha256: {key(40)} of it") for i in range(20)]
    rows = [(i, f"{'some words ' * draw.randrange(8)}{x}{' more words' * draw.randrange(8)}") for i, x in rows]
    found = {r.doc_id: r for r in scan(frame(rows)).collect()}
    share = lambda a, b: sum(found[i].is_secret for i in range(a, b) if i in found) / sum(i in found for i in range(a, b))
    assert share(0, 300) > 0.97 and share(3000, 3100) > 0.9
    assert share(1000, 1300) == share(2000, 2300) == share(5000, 5020) == 0
    assert share(4000, 4020) < 0.3


def test_forest_on_held_out_findings(frame):
    draw = random.Random(6)
    rows = []
    for i in range(400):
        key = "".join(draw.choice("0123456789abcdef") for _ in range(40))
        card = "".join(draw.choice("0123456789") for _ in range(draw.choice([16, 19])))
        name = draw.choice(["token", "api_key", "secret", "password"])
        rows.append((i, f'call it with {name} = "{key}" and pay' if i % 2 else f"the number {card} on the card"))
    found = labelled_findings(features(candidates(frame(rows)))).cache()
    model = train(found.where("doc_id < 300"), Forest(trees=10))
    scored = scan(frame(rows[300:]), found.where("doc_id < 300"), Forest(trees=10)).collect()
    assert model.getNumTrees == 10 and len(scored) == 100
    assert sum(r.is_secret == (r.doc_id % 2 == 1) for r in scored) >= 99
    assert train(found.where("label = 0")) is None
    found.unpersist()
