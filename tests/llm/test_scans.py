import hashlib
import math
import random
import re

import numpy as np
import pytest
from compare import SF, same
from eventloom.llm import licenses, secrets
from eventloom.llm.decontaminate import contamination, contamination_report, drop_contaminated
from eventloom.llm.queries import ORACLES, QUERIES
from helpers import LOW, TEXTS, WORD, docs, empty
from pyspark.sql import functions as F

# Secrets.
ASSIGN = re.compile("((?:" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")) + r"""))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    t = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m.group(2)) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 16]
    return sorted(found)


def test_secrets_of_odd_rows(spark):
    r = random.Random(3)
    bits = ["token", "secret", "PASSWORD", "api_key", "apikey", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGHIJ12", "0123456789abcdef", "abcdefghijkl", "é", "\U0001f600", "\n", ".", "short", "ſecret"]
    texts = [*TEXTS, *("".join(r.choice(bits) for _ in range(r.randint(0, 25))) for _ in range(300))]
    got = {x.doc_id: x for x in secrets.secrets_report(secrets.scan_secrets(docs(spark, texts))).collect()}
    for i, t in enumerate(texts):
        want = base(t)
        text = ",".join(f"{secrets.KINDS[k]}:{a}:{e}" for a, k, e in want)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(k == n for _, k, _ in want) for n in range(3)), t
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(got[i].spans.split(","))
    assert secrets.scan_secrets(empty(spark)).count() == 0
    assert secrets.scan_secrets(docs(spark, ["a", "a"], [None, None])).count() == 2


def test_random_strings_are_told_from_words(spark):
    r = random.Random(1)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(r.choice(b64) for _ in range(40)) for _ in range(60)]
    words = ["ThisIsNotASecretButTheNameOfSomeSetting2", "getElementByIdAndClassName2FromTheDocument", "AAAAaaaa1111AAAAaaaa1111AAAAaaaa1111AAAA"] * 20
    texts = [f"see {k} here" for k in keys + words]
    got = {x.doc_id: "random" in x.spans for x in secrets.secrets_report(secrets.scan_secrets(docs(spark, texts))).collect()}
    assert sum(got[i] for i in range(60)) >= 54 and not any(got[i] for i in range(60, 120))


def test_value_after_an_equals_sign_is_a_candidate(spark):
    r = random.Random(2)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    names = ["AWS_SECRET_ACCESS_KEY=", "AUTH_KEY=", "Bearer=", "https://a.b/c?sig=", "k=v&sig=", "="]
    texts = [names[i % 6] + "".join(r.choice(b64) for _ in range(42)) + "=" * (i % 3) for i in range(60)]
    spans = [f"random:{len(names[i % 6])}:{len(t)}" for i, t in enumerate(texts)]
    got = {x.doc_id: x.spans for x in secrets.secrets_report(secrets.scan_secrets(docs(spark, texts))).collect()}
    assert sum(got[i] == spans[i] for i in range(60)) >= 54


FAMILIES = {
    "hex": "0123456789abcdef", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}


@pytest.mark.parametrize("share", [1.0, 0.1])
def test_share_of_keys_found_by_encoding_and_length(spark, share):
    r = random.Random(6)
    words = "setting name document element class value of the is not and by id first last number time user".split()

    def plain(alphabet, n):
        letters = {"hex": "aaaaeeeeedddbc"}.get(alphabet)
        s = "".join(r.choice(letters) for _ in range(n)) if letters else "".join(w.upper() if alphabet == "base32" else w.title() for w in r.choices(words, k=n))[:n]
        return s[: n - 1] + "2"

    made = []
    for name, alphabet in FAMILIES.items():
        for n in (20, 24, 32, 40):
            made += [(name, n, True, "".join(r.choice(alphabet) for _ in range(n))) for _ in range(50)]
            made += [(name, n, False, plain(name, n)) for _ in range(round(50 / share) - 50)]
    rows = spark.createDataFrame([(i, t) for i, (_, _, _, t) in enumerate(made)], "row_no long, token string")
    tested = rows.withColumn("encoding", secrets.infer_encoding(rows.token)).where("encoding is not null")
    hit = {x.row_no for x in secrets.discoveries(secrets.battery(tested)).where("found").collect()}
    found = {}
    for i, (name, n, key, _) in enumerate(made):
        found.setdefault((name, n, key), []).append(i in hit)
    shares = {k: sum(v) / len(v) for k, v in found.items()}
    assert all(v >= 0.7 if key else v <= 0.02 for (_, _, key), v in shares.items()), shares


def plain_battery(token, alphabet):
    """The three tests and their combined p-value, one string at a time."""
    codes = [alphabet.index(c) for c in token.replace("-", "+").replace("_", "/") if c in alphabet]
    n, k, middle = len(codes), len(alphabet), (len(alphabet) - 1) / 2
    chi2 = sum(codes.count(v) ** 2 for v in set(codes)) * k / n - n
    chi_z = (chi2 - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
    sides = [2 * c >= k for c in codes]
    runs, high = 1 + sum(a != b for a, b in zip(sides, sides[1:], strict=False)), sum(sides)
    mean = 2 * high * (n - high) / n + 1
    runs_z = (runs - mean) / math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
    serial_z = sum((a - middle) * (b - middle) for a, b in zip(codes, codes[1:], strict=False)) / ((k * k - 1) / 12 * math.sqrt(n - 1))
    ps = [min(math.erfc(abs(z) / math.sqrt(2)), 0.9) for z in (chi_z, runs_z, serial_z)]
    return chi2, chi_z, runs_z, serial_z, 0.5 - math.atan(sum(math.tan((0.5 - p) * math.pi) for p in ps) / 3) / math.pi


def test_battery_against_a_plain_version(spark):
    r = random.Random(12)
    made = [(name, "".join(r.choice(a[: r.choice([3, len(a)])]) for _ in range(r.choice([20, 33, 64, 200])))) for name, a in secrets.ALPHABETS.items() for _ in range(25)]
    rows = spark.createDataFrame([(i, t, name) for i, (name, t) in enumerate(made)], "row_no int, token string, encoding string")
    for x in secrets.battery(rows).collect():
        want = plain_battery(x.token, secrets.ALPHABETS[x.encoding])
        assert np.allclose([x.chi2, x.chi_z, x.runs_z, x.serial_z], want[:4]) and abs(x.p_random - want[4]) < 1e-5, (x, want)


@pytest.mark.parametrize("name", ["hex", "base32", "base36", "base64"])
def test_battery_keeps_its_rate_on_random_strings(spark, name):
    """Of random strings of any length, the combined p-value is below 0.01 for about a hundredth."""
    r = random.Random(13)
    rows = spark.createDataFrame([(n, "".join(r.choice(secrets.ALPHABETS[name]) for _ in range(n)), name) for n in (20, 24, 32, 40, 64) for _ in range(1000)], "n0 int, token string, encoding string")
    low = {x.n0: x.low for x in secrets.battery(rows).groupBy("n0").agg(F.avg((F.col("p_random") < 0.01).cast("double")).alias("low")).collect()}
    assert len(low) == 5 and all(0.001 <= v <= 0.03 for v in low.values()), low


def plain_threshold(ps, rate):
    """Benjamini-Hochberg with p-values as the upper ends of their bins."""
    ends = [10 ** (-math.floor(-math.log10(p) * secrets.BINS_PER_DECADE) / secrets.BINS_PER_DECADE) for p in ps]
    best = 0.0
    for e in set(ends):
        if e <= sum(x <= e * (1 + 1e-9) for x in ends) / len(ends) * rate:
            best = max(best, e)
    return [e <= best * (1 + 1e-9) for e in ends]


def test_thresholds_against_a_plain_version(spark):
    r = random.Random(14)
    rows = [(i, r.choice(["hex", "base64"]), float(r.choice([22, 30, 50])), 10 ** -r.uniform(0, 3), 10 ** -(r.uniform(0, 1) if r.random() < 0.6 else r.uniform(0, 9))) for i in range(600)]
    got = {x.i: (x.rejected, x.found) for x in secrets.discoveries(spark.createDataFrame(rows, "i int, encoding string, n double, p_random double, p double")).collect()}
    for key in {(e, n) for _, e, n, _, _ in rows}:
        own = [x for x in rows if x[1:3] == key]
        rejected = plain_threshold([x[3] for x in own], secrets.FALSE_REJECTIONS)
        found = plain_threshold([1.0 if bad else x[4] for x, bad in zip(own, rejected, strict=True)], secrets.FALSE_DISCOVERIES)
        assert [got[x[0]] for x in own] == list(zip(rejected, found, strict=True))


def test_keys_of_every_alphabet_are_candidates(spark):
    r = random.Random(9)
    key = lambda symbols, n: "".join(r.choice(symbols) for _ in range(n))
    low, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    made = {
        "upper hex": lambda: key(digits + "ABCDEF", 40), "lower base32": lambda: key(low + "234567", 32), "lower base36": lambda: key(digits + low, 32), "upper base36": lambda: key(digits + low.upper(), 32),
        "uuid": lambda: "-".join(key(digits + "abcdef", n) for n in (8, 4, 4, 4, 12)), "slashes": lambda: "/".join(key(digits + "abcdef", 10) for _ in range(4)), "no digit": lambda: key(low + low.upper(), 40),
    }
    words = [
        "this-is-the-name-of-some-article", "org/apache/spark/sql/catalyst/expressions", "SOME_CONSTANT_NAME_OF_SETTING", "20240115123456789012", "2024-01-15-12-30-59-000123",
        "onthtionwhonattionnd", "Einungtzheitgeungverlich", "Donaudampfschifffahrtsgesellschaft", "--------------------", "____________________________", "user-2024-01-15-report-final-v2", "00000000-0000-0000-0000-000000000000",
    ]
    texts = [f"see {make()} here" for make in made.values() for _ in range(40)] + [f"see {w} here" for w in words * 10]
    got = {x.doc_id: x.spans for x in secrets.secrets_report(secrets.scan_secrets(docs(spark, texts))).collect()}
    shares = {name: sum(got[40 * k + i] == f"random:4:{len(texts[40 * k + i]) - 5}" for i in range(40)) / 40 for k, name in enumerate(made)}
    assert all(v >= 0.8 for v in shares.values()), shares
    assert not {texts[i] for i in range(40 * len(made), len(texts)) if "random" in got[i]}


# Benchmark passages.
def brute(texts, items):
    words = lambda t: WORD.findall((t or "").translate(LOW))
    windows = {}
    for item, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9)) if w else []:
            windows.setdefault(tuple(w[k : k + 10]), set()).add("" if item is None else str(item))
    for i, t in enumerate(texts):
        w, hit, found = words(t), set(), set()
        for win, of in windows.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    found |= of
        yield i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("pattern_chars", [3_000_000, 60])
def test_contamination(spark, pattern_chars):
    r = random.Random(8)
    say = lambda n: " ".join(r.choice(["a", "b", "É", "c1"]) for _ in range(n))
    items = [(1, say(12)), (2, say(3)), (10, "a"), (11, None), (12, "?!"), (None, "zz É"), (2, say(11))]
    texts = [*TEXTS, *(r.choice([say(r.randint(0, 40)), "x, " + (items[0][1] or "").upper() + "... y", items[6][1].replace(" ", " - ")]) for _ in range(60))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = contamination(docs(spark, texts), bench, pattern_chars=pattern_chars)
    assert sorted(tuple(x) for x in contamination_report(found).collect()) == sorted(brute(texts, items))
    for x in found.collect():
        for run in x.runs:
            inside = texts[x.doc_id][run.start : run.end]
            assert len(WORD.findall(inside.translate(LOW))) == run.end_word - run.first_word
    clean = drop_contaminated(docs(spark, texts), bench, pattern_chars=pattern_chars)
    assert sorted(x.doc_id for x in clean.collect()) == [b[0] for b in brute(texts, items) if not b[-1]] and clean.columns == docs(spark).columns


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [x.contaminated for x in contamination_report(contamination(docs(spark, ["a b"]), none)).collect()] == [False]
    assert contamination(empty(spark), none).count() == 0 and drop_contaminated(docs(spark, ["a"]), none).count() == 1


def test_contamination_by_other_items_in_one_session(spark):
    marks = [f"mark{i} of its own" for i in range(12)]
    rows = docs(spark, marks).repartition(1)
    for i, mark in enumerate(marks):
        bench = spark.createDataFrame([(i, mark)], "item_id long, text string")
        assert [(x.doc_id, list(x["items"])) for x in contamination(rows, bench).where("size(items) > 0").collect()] == [(i, [str(i)])]
        assert sorted(x.doc_id for x in drop_contaminated(rows, bench).collect()) == [k for k in range(12) if k != i]


def test_contamination_query(spark):
    same(spark, QUERIES["op5_decontaminate"], ORACLES["op5_decontaminate"])


# Licenses.
def names(text):
    w = re.findall("[a-z0-9]+", (text or "").translate(LOW))
    sh = [" ".join(w[k : k + 5]) for k in range(len(w) - 4)]
    found = []
    for t in licenses.prepare():
        per = t.size - 4
        for a in range(max(1, len(sh) - per + 1)):
            shared = [k for k in range(a, min(len(sh), a + per)) if sh[k] in t.shingles]
            if (held := len({sh[k] for k in shared}) / len(t.shingles)) >= 0.8:
                found.append((shared[0], held, t.name))
    best = {}
    for start, held, _ in found:
        best[start] = max(held, best.get(start, 0))
    return ",".join(sorted({name for start, held, name in found if held == best[start]}))


def test_versions_of_a_license(spark):
    texts = ["This work is licensed under the GNU General Public License, version 2.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC-SA 4.0", "Distributed under the MIT License"]
    got = {x.doc_id: x.licenses for x in licenses.licenses_report(licenses.scan_licenses(docs(spark, texts))).collect()}
    assert got == {0: "GPL-2.0", 1: "GPL-3.0", 2: "CC-BY-NC-SA-4.0", 3: "MIT"}


def test_licenses(spark):
    r = random.Random(5)
    texts = list(TEXTS)
    for _, t in licenses.TEMPLATES:
        texts += [t, f"Some words before. {t}! And é after it", t.upper().replace(" ", "\n  "), t.replace(" ", " x ", 1), " ".join(w for w in t.split() if r.random() > 0.3), f"{t}. {t}"]
    found = licenses.scan_licenses(docs(spark, texts))
    for x in licenses.licenses_report(found).collect():
        assert x.licenses == names(texts[x.doc_id]), texts[x.doc_id]
    for x in found.collect():
        for m in x.matches:
            assert m.containment >= 0.8 and names(texts[x.doc_id][m.start : m.end]), texts[x.doc_id][m.start : m.end]
    assert licenses.scan_licenses(empty(spark)).count() == 0
    with pytest.raises(ValueError, match="words"):
        licenses.prepare((("short", "three words only"),))


def test_license_filters_lose_nothing():
    known = licenses.prepare()
    telling = set(licenses.telling_words(known))
    for t in known:
        assert sum(bool(telling & set(s.split())) for s in t.shingles) > 0.2 * len(t.shingles)
        need = -(-8 * len(t.shingles) // 10)
        least = need / ((t.size - 4) + len(t.shingles) - need)  # Jaccard of a window that holds just enough
        assert 1 - (1 - least) ** t.bands >= licenses.RECALL


@pytest.mark.parametrize("name", ["op4_secrets", "op10_licenses"])
def test_queries(spark, name):
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
