"""Jaccard join, classifier, pseudonyms, secrets, fingerprints: against brute force, round trips and held-out labels."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from mentionflow.llm import iblt, jaccard, pii, quality, secrets

from .conftest import NASTY


def words(text):
    return tuple(w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w)


def near_by_hand(rows, threshold=0.8):
    texts = defaultdict(list)
    for i, t in rows:
        texts[words(t)].append(i)
    sets = [{w[k : k + 5] for k in range(max(1, len(w) - 4))} if w else set() for w in texts]
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    parent, links = list(range(len(sets))), [0] * len(sets)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and n >= threshold * (len(sets[a]) + len(sets[b]) - n):
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    groups = defaultdict(list)
    for k, ids in enumerate(texts.values()):
        groups[find(k)] += ids
    out = []
    for k, ids in enumerate(texts.values()):
        out += [(i, least(groups[find(k)]), links[k], least(ids), len(ids)) for i in ids]
    return sorted(out, key=str)


def near(df, **limits):
    return sorted((tuple(r)[:5] for r in jaccard.similar_documents(df, **limits).collect()), key=str)


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.choice([3, 8, 60, 150]))) for _ in range(60)]
    texts = base + [edited(rng, rng.choice(base), rng.randrange(4)) for _ in range(90)]
    hot = " ".join(f"h{rng.randrange(500)}" for _ in range(120))
    texts += [edited(rng, hot, 1 + rng.randrange(3)) for _ in range(120)] + [base[3]] * 4
    return list(enumerate(texts, 1))


def test_similar_documents(spark, docs, corpus):
    rows = corpus + NASTY
    assert near(docs(rows)) == near_by_hand(rows)


@pytest.mark.parametrize("ball, block", [((16, 3000), (10, 1500)), ((1, 1), (40, 10**6))])
def test_large_groups_go_by_their_home_and_by_blocks(spark, docs, corpus, ball, block):
    assert near(docs(corpus), ball=ball, block=block) == near_by_hand(corpus)


def test_rows_of_a_node_do_not_grow_with_its_group(spark, docs):
    """A text of a group of near copies is sent once if the group is close, and to few blocks if not."""
    from mentionflow.llm.common import Scratch

    rng = random.Random(3)
    base = " ".join(f"h{rng.randrange(900)}" for _ in range(300))
    rows = list(enumerate((edited(rng, base, 1) for _ in range(900)), 1))
    got = jaccard.similar_documents(docs(rows), ball=(50, 10**6), block=(50, 10**6)).collect()
    distinct = len({t for _, t in rows})
    assert {r.n_links for r in got} == {distinct - 1} and {r.class_id for r in got} == {1}
    scratch = Scratch(spark, "rows")
    each = scratch.keep(jaccard.prepared(docs(rows)).mapInArrow(jaccard.signed, jaccard.SIGNED), "signed")
    near_ = jaccard.balls(jaccard.buckets_of(each.select(F.col("rid").alias("node"), "words", "bands"), scratch), scratch)
    assert near_.count() < 3 * distinct


def test_near_query_by_hand(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r)[:5] for r in jaccard.op5_jaccard_join(spark, sf_dir).collect()), key=str)
    assert got == near_by_hand(rows) and any(r[2] for r in got)


def test_links_near_the_threshold_are_found(spark, docs):
    """Pairs of texts with a similarity of 0.80 to 0.85: every one that brute force finds."""
    rng = random.Random(8)
    texts = []
    for k in range(300):
        base = [f"w{rng.randrange(50_000)}" for _ in range(rng.choice([60, 120, 240]))]
        other = list(base)
        for at in rng.sample(range(len(base) // 7), max(1, len(base) // 60)):  # each apart from the others: five shingles differ
            other[at * 7 + 3] = f"z{k}-{at}"
        texts += [" ".join(base), " ".join(other)]
    rows = list(enumerate(texts, 1))
    want = near_by_hand(rows)
    close = 0
    for a, b in zip(texts[::2], texts[1::2], strict=True):
        x, y = ({w[i : i + 5] for i in range(len(w) - 4)} for w in (words(a), words(b)))
        close += 0.8 <= len(x & y) / len(x | y) < 0.88
    assert close > 50 and near(docs(rows)) == want


def test_no_rows_and_no_links(spark, docs):
    assert near(docs([])) == []
    assert near(docs([(1, "a b c d e f"), (2, None)])) == [(1, 1, 0, 1, 1), (2, 2, 0, 2, 1)]


def test_one_of_each_class(docs, corpus):
    df = docs(corpus + [corpus[0]])
    kept = jaccard.one_of_each_class(df)
    want = {c for _, c, *_ in near_by_hand(corpus)}
    assert kept.columns == df.columns and Counter(r.doc_id for r in kept.collect()) == Counter(want)


def test_pruning_keeps_what_may_reach_the_threshold():
    least = jaccard.least_matches(0.8, 1e-9)
    assert least == sorted(least) and all(m <= 0.6 * n for m, n in zip(least, range(32, 129, 32), strict=True))
    rng = np.random.default_rng(1)
    for n, m in zip(range(32, 129, 32), least, strict=True):
        assert (rng.binomial(n, 0.8, 200_000) < m).sum() == 0


def test_components(spark):
    from mentionflow.llm.common import Scratch

    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(0, 99)] + [(200, 200 + k) for k in range(1, 50)] + [(1000 + rng.randrange(30), 1000 + rng.randrange(30)) for _ in range(25)] + [(7, 7)]
    df = spark.createDataFrame(pairs, "u long, v long")
    label = {r.node: r.label for r in jaccard.components(df, Scratch(spark, "test"), "t").collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in pairs:
        parent[find(u)] = find(v)
    groups = defaultdict(set)
    for x in label:
        groups[find(x)].add(label[x])
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


# -- classifier ------------------------------------------------------------------------------------


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in quality.op6_quality_classifier(spark, sf).collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    held = [(got[i].predicted, q) for i, q in labels if got[i].held_out]
    assert np.mean([p == q for p, q in held]) >= 0.95
    import zlib

    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    again = {r.doc_id: r.score for r in quality.op6_quality_classifier(spark, sf).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_classifier_on_odd_tables(spark, nasty, docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 1), (6, None), (None, 1), (99, 0)], "doc_id long, quality int")
    for table in (labels, labels.limit(0), labels.filter("quality = 1")):
        model = quality.train(nasty, table)
        rows = quality.score(nasty, model, nasty.columns).collect()
        assert len(rows) == len(NASTY) and all(0 <= r.score <= 1 for r in rows)
        assert quality.score(nasty.limit(0), model, ["doc_id"]).count() == 0


def features_by_hand(text):
    """Counts of the features of one text, one at a time."""
    prime, mask, found = 0x100000001B3, 2**64 - 1, Counter()

    def bucket(h):
        h = (h ^ (h >> 32)) * 0x9E3779B97F4A7C15 & mask
        return h >> (64 - quality.BUCKETS.bit_length() + 1)

    plain = "".join(" " if ord(c) <= 32 or ord(c) == 0xA0 else c for c in text) + " "
    words = [w for w in plain.split(" ") if w]
    seen, backs = {}, []
    for k, w in enumerate(words):
        h = sum(ord(c) * pow(prime, min(j, 255), 2**64) for j, c in enumerate(w)) & mask
        found[bucket(h + 0x51 & mask)] += 1
        backs.append(k - seen[h] if h in seen else 0)
        seen[h] = k
        token = (100 if k and backs[k] and backs[k] == backs[k - 1] else 0) + int(np.ceil(np.log2(backs[k] + 1)))
        found[bucket(token + 0x5252)] += 1
    chars = re.sub(" +", " ", plain)
    for n in quality.GRAMS:
        for k in range(len(chars) - n + 1):
            h = 0
            for c in chars[k : k + n]:
                h = h * prime + ord(c) & mask
            found[bucket(h + (n << 40) & mask)] += 1
    return found


def test_scores_against_plain_features(spark, docs, sf_dir):
    """Scoring a table is the mean of the model's numbers over features counted by hand, whatever shares a batch with a text."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect() if len(r.text or "") < 4000]
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, "one"), (1004, "a b a b a b  a\tb é日🎉 é日🎉"), (1005, "x" * 3000)]
    rng = np.random.default_rng(2)
    model = (rng.normal(size=quality.BUCKETS).astype(np.float32), 0.25)
    got = {r.doc_id: r.score for r in quality.score(docs(rows), model, ["doc_id"]).collect()}
    for i, text in rows:
        n = features_by_hand(text) if text else Counter()
        mean = sum(float(model[0][b]) * k for b, k in n.items()) / max(1, sum(n.values()))
        assert got[i] == pytest.approx(1 / (1 + np.exp(-(mean + 0.25))), rel=1e-9)


def test_features_do_not_cross_documents():
    together, alone = quality.features(["ab cd", "ef"]), [quality.features([t])[1] for t in ("ab cd", "ef")]
    for k in (0, 1):
        assert sorted(together[1][together[0] == k]) == sorted(alone[k])


# -- pseudonyms ------------------------------------------------------------------------------------

KEY = b"key"
VALUES = {
    "email": "jürgen.x9@mail7.example.com", "number": "4111 1111 1111 1111", "phone": "+1 (511) 555-6887", "ssn": "123-45-6789", "iban": "DE89 3704 0044 0532 0130 00", "ipv4": "5.203.196.18", "date": "2024-02-29",
}


def test_permutations_are_one_to_one():
    for size in (2, 9, 100, 1000):
        image = [pii.permuted(x, size, KEY, b"t") for x in range(size)]
        assert sorted(image) == list(range(size)) and [pii.permuted(y, size, KEY, b"t", True) for y in image] == list(range(size))


@pytest.mark.parametrize(("kind", "value"), [*VALUES.items(), ("date", "13/02/2024"), ("date", "02.13.2024"), ("number", "4363361756619572"), ("phone", "555-123-4567"), ("ipv4", "0.0.0.255")])
def test_pseudonyms_keep_the_format(kind, value):
    text = f"Of {value} and {value}, then."
    new, found = pii.pseudonymised(text, KEY)
    assert [k for _, _, k in found] == [kind] * 2 and value not in new
    a, b = (new[s:e] for s, e, _ in pii.found_in(new)) if kind != "ipv4" else re.findall(r"[\d.]+\d", new)
    assert a == b and re.sub("[0-9]", "0", a.lower() if kind == "email" else a) and pii.pseudonymised(new, KEY, True)[0] == text
    if kind in ("ssn", "date", "phone", "number"):
        assert re.sub("[0-9]", "0", a) == re.sub("[0-9]", "0", value)
    if kind == "number":
        ok = lambda v: pii.luhn(pii.only_digits(v)[:-1]) == int(v[-1])
        assert ok(a) == ok(value)
    assert pii.pseudonymised(text, b"other key")[0] != new


@pytest.mark.parametrize("n", [255, 256, 257, 3_200, 20_000, 1_000_000])
def test_pseudonyms_of_long_addresses(n):
    for value in ("aZ9." * (n // 4) + "q@example.com", "bob@" + "bC-3" * (n // 4) + ".com"):
        text = f"see {value} now"
        new, found = pii.pseudonymised(text, b"k")
        shape = lambda t: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", t)))
        assert len(found) == 1 and new != text and shape(new) == shape(text) and pii.pseudonymised(new, b"k", undo=True)[0] == text
        assert pii.pseudonymised(text, b"other")[0] != new == pii.pseudonymised(text, b"k")[0]


def test_a_day_has_one_pseudonym_in_all_forms():
    import datetime

    new = lambda v: pii.pseudonymised(f"on {v} x", KEY)[0].split()[1]
    for k in range(400):
        day = datetime.date(2023, 1, 1) + datetime.timedelta(k)
        iso = new(day.isoformat())
        y, m, d = iso.split("-")
        assert new(day.strftime("%d/%m/%Y")) == f"{d}/{m}/{y}" and new(day.strftime("%Y.%m.%d")) == f"{y}.{m}.{d}"
        if day.day > 12:
            assert new(day.strftime("%m/%d/%Y")) == f"{m}/{d}/{y}"


def plain_values(text):
    """Addresses, dates, social security numbers and IPv4 addresses by another way: words are cut out and taken apart."""
    import datetime

    found = []
    for m in re.finditer(r"[^\s,;:!?()<>\"']+", text):
        word = m.group().rstrip(".")
        digits = [p for p in re.split(r"[-/.]", word)]
        if word.count("@") == 1 and "." in word.partition("@")[2] and re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", word):
            found.append(("email", m.start(), m.start() + len(word)))
        elif all(p.isascii() and p.isdigit() for p in digits):
            if word.count(".") == 3 and all(int(p) < 256 and str(int(p)) == p for p in digits):
                found.append(("ipv4", m.start(), m.start() + len(word)))
            elif word.count("-") == 2 and [len(p) for p in digits] == [3, 2, 4]:
                a, b, c = map(int, digits)
                if 0 < a < 900 and a != 666 and b and c:
                    found.append(("ssn", m.start(), m.start() + len(word)))
            elif len(digits) == 3 and [len(p) for p in digits] == [4, 2, 2] and len(set(re.findall(r"[-/.]", word))) == 1:
                try:
                    if 1900 <= datetime.date(*map(int, digits)).year < 2100:
                        found.append(("date", m.start(), m.start() + len(word)))
                except ValueError:
                    pass
    return found


def test_pseudonyms_query_against_another_finder(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got, n = pii.op7_pii_pseudonyms(spark, sf).collect(), Counter()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r.doc_id]
        if text is None:
            assert r.text is None and r.spans == ""
            continue
        spans = [(k, int(s), int(e)) for k, s, e in (x.rsplit(":", 2) for x in r.spans.split(",") if x)]
        for value in plain_values(text):
            n[value[0]] += 1
            assert value in spans, (r.doc_id, value, text[value[1] : value[2]])
        # Everything outside the spans is as it was, lengths but those of months and the like are kept, and it can be undone.
        parts, last = [], 0
        for _, s, e in spans:
            parts.append(re.escape(text[last:s]) + ".{1,60}?")
            last = e
        assert re.fullmatch("".join(parts) + re.escape(text[last:]), r.text, re.S)
        assert pii.pseudonymised(r.text, pii.DEMO_KEY, True)[0] == text
    assert n["email"] > 5, n


def test_what_is_not_valid_stays():
    for text in ("2024-02-30 x", "1.2.3.400 x", "000-12-3456", "in 2024 12 34", 'token = "65f8700754a1d8161928a1d0cca87c"', "DE88 3704", "a@b", "v1.2.3.4.5", "7 ٠١٢٣٤٥٦٧٨٩٠١٢٣٤", "7 ١٢٣-٤٥-٦٧٨٩ ٢٠٢٤-٠١-٠٢", ""):
        assert pii.pseudonymised(text, KEY) == (text, [])


def test_pseudonyms_of_a_table(spark, nasty, docs):
    got = {(r.doc_id, r.text, r.n_found) for r in pii.pseudonyms(nasty, KEY).collect()}
    assert got == {(i, t, 0) for i, t in NASTY}
    df = docs([(1, f"a {VALUES['email']} b"), (2, f"c {VALUES['email']} {VALUES['ssn']}"), (3, None)])
    one, two, three = pii.pseudonyms(df, KEY).orderBy("doc_id").collect()
    assert one.kinds == "email:1" and two.kinds == "email:1,ssn:1" and three.text is None
    assert one.text.split()[1] == two.text.split()[1] != VALUES["email"]
    back = pii.pseudonyms(pii.pseudonyms(df, KEY), KEY, undo=True)
    assert {(r.doc_id, r.text) for r in back.collect()} == {(r.doc_id, r.text) for r in df.collect()}


# -- secrets ---------------------------------------------------------------------------------------


def base_by_hand(text):
    text, found = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m.group(2)) >= 6:
            found.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for k, kind, pattern, least in ((1, "access", "AKIA[A-Z0-9]+", 20), (2, "hex", "[0-9a-f]+", 24)):
        found += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m.group()) >= least]
    return (*(sum(x[1] == k for x in found) for k in range(3)), ",".join(x[2] for x in sorted(found)))


SECRETS = [
    "password=token =abcdefg", "TOKEN: 'abcdef' paſſword=abcdefg", "api_key:abcde", "Api_Key = \"a.b=c/d\"", "AKIAAKIA" + "A" * 12, "AKIA" + "Z" * 15, "é" + "0" * 24, "f" * 23 + " " + "0123456789abcdef" * 3, "secret:secret:secret=123456", "",
]


def test_base_patterns(spark, docs, sf_dir):
    rows = list(enumerate(SECRETS)) + NASTY + [(r.doc_id + 10_000, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_spans) for r in secrets.secret_spans(docs(rows)).collect()), key=str)
    assert got == sorted(((i, *base_by_hand(t)) for i, t in rows), key=str)
    assert secrets.secret_spans(docs([])).count() == 0


def entropy(s):
    return -sum(n / len(s) * np.log2(n / len(s)) for n in Counter(s).values())


def test_windows_against_plain_entropy():
    rng = random.Random(3)
    for _ in range(200):
        s = "".join(rng.choice("abcdef0123456789"[: rng.randrange(2, 16)]) for _ in range(rng.randrange(10, 60)))
        marked = set()
        for i in range(len(s) - 19):
            if entropy(s[i : i + 20]) >= 3.0:
                marked |= set(range(i, i + 20))
        assert {p for a, b in secrets.entropy_windows(s, 20, 3.0) for p in range(a, b)} == marked


def test_entropy_and_allow_list():
    key = "q8Zt3LpX0vRk7WmB2nYc5HsD"
    assert secrets.entropy_spans(f"use {key} now") == [(4, 4 + len(key), "entropy")]
    for text in ("wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "123e4567-e89b-12d3-a456-426614174000", "Donaudampfschifffahrtsgesellschaft", "some-long-slug-of-a-title-12", "2024-01-02/2024-01-03/12", "a" * 40 + "1"):
        assert secrets.entropy_spans(text) == []


# -- fingerprints ----------------------------------------------------------------------------------


def likeness_by_hand(a, b):
    a, b = (set(iblt.passages(t).tolist()) for t in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_of_a_table(spark, nasty):
    hashed = {(r.doc_id, r.text): r.h for r in nasty.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    rows = sorted(((i, t or "") for i, t in NASTY), key=lambda r: (r[0] is None, -(r[0] or 0), hashed[r]))
    place = {(i, len(t)): k for k, (i, t) in enumerate(rows)}
    got = sorted(iblt.document_fingerprints(nasty).collect(), key=lambda r: place[r.doc_id, r.n_chars])
    assert len(got) == len(rows)
    prints = {}
    for k, ((i, t), r) in enumerate(zip(rows, got, strict=True)):
        following = rows[(k + 1) % len(rows)][1]
        n = len(t) // 3
        edit = t[: len(t) - n] + following[:n]
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (i, len(t), hashlib.sha256(edit.encode()).hexdigest())
        assert r.near_edited == likeness_by_hand(t, edit) and r.near_next == likeness_by_hand(t, following)
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint and (edit not in prints or prints[edit] == r.edited_fingerprint)
    assert iblt.document_fingerprints(nasty.limit(0)).count() == 0
    alone = iblt.document_fingerprints(nasty.filter("doc_id = 5")).first()
    assert alone.near_next == 1.0


def test_fingerprint_query_against_sets(spark):
    """All rows of the registered query, in many ranges, against likeness of plain sets."""
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    order = sorted(texts, reverse=True)
    following = dict(zip(order, [*order[1:], order[0]], strict=True))
    for ranges in ("3", "37"):
        spark.conf.set("spark.sql.shuffle.partitions", ranges)
        try:
            got = {r.doc_id: r for r in iblt.op10_iblt_fingerprints(spark, sf).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert set(got) == set(texts)
        for i, r in got.items():
            text, other = texts[i], texts[following[i]]
            edit = text[: len(text) - len(text) // 3] + other[: len(text) // 3]
            assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edit.encode()).hexdigest())
            assert r.near_edited == likeness_by_hand(text, edit) and r.near_next == likeness_by_hand(text, other)


def test_peeling_recovers_differences():
    rng = np.random.default_rng(4)
    left, right, only = [], [], []
    for n in (0, 1, 5, 40, 300):
        for shared in (0, 10, 500):
            keys = np.unique(rng.integers(0, 2**63, shared + 2 * n, dtype=np.uint64))
            rng.shuffle(keys)
            left.append(np.sort(keys[: shared + n]))
            right.append(np.sort(np.r_[keys[:shared], keys[shared + n :]]))
            only.append((n, len(keys) - shared - n))
    a, b = iblt.differences(left, right)
    assert list(zip(a.tolist(), b.tolist(), strict=True)) == only


def test_ranges_are_bounded(spark, docs, monkeypatch):
    """Ranges hold a bounded number of bytes, whatever the sizes of texts: cuts come from a sort of all rows, not from a sample."""
    rng = np.random.default_rng(8)
    sizes = [*rng.integers(0, 400, 3_000).tolist(), 30_000, 30_000, 9_000]
    rows = docs([(i if i % 3 else None, "y" * n) for i, n in enumerate(sizes)]).withColumn("digest", F.xxhash64("text"))
    monkeypatch.setattr(iblt, "RANGE_BYTES", 10_000)
    cuts = iblt.cuts_of(rows)
    keyed = rows.selectExpr("doc_id", "digest", "octet_length(text) + 100 AS n").toPandas()
    keys = iblt.order_keys(keyed.doc_id.isna().to_numpy(), keyed.doc_id.fillna(0).to_numpy(), keyed.digest.to_numpy())
    at = np.searchsorted(cuts, keys, side="right") - 1
    assert at.min() == 0 and len(np.unique(at)) == len(cuts)
    # Rows repeated with one id and hash stay together; of the others none is above the bound unless it is one row.
    _, one = np.unique(keys, return_index=True)
    held, rows_of = np.bincount(at[one], weights=keyed.n.to_numpy()[one]), np.bincount(at[one])
    assert all(n <= 10_000 or k == 1 for n, k in zip(held, rows_of, strict=True)) and len(cuts) > 60


def test_training_features_are_bounded(spark, docs):
    """Texts with many features take the place of later ones: what the driver holds is bounded, and reruns agree."""
    rows = docs([(i, (f"good words number {i} " if i % 2 else "b@d ") * (400 if i % 5 == 0 else 3)) for i in range(1, 80)])
    marks = spark.createDataFrame([(i, i % 2) for i in range(1, 80)], "doc_id long, quality int")
    seen = []

    def spy(labels, rows):
        seen.append((len(labels), sum(len(ids) for ids, _ in rows)))
        return fit(labels, rows)

    fit, quality.fit = quality.fit, spy
    try:
        quality.train(rows, marks, train_features=600)
        whole = quality.train(rows, marks)
    finally:
        quality.fit = fit
    again = quality.train(rows, marks)
    assert 0 < seen[0][1] <= 600 < seen[1][1] and 0 < seen[0][0] < seen[1][0] == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(1, 80))
    assert (whole[0] == again[0]).all() and whole[1] == again[1]
