"""Fill-in-middle, personal data and importance resampling against brute force, SQL and round trips, and on odd input."""

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import regex

from plenaria.llm import importance, infill, personal, queries

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
from check_queries import KINDS, digest  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
ODD = [(1, "same words in a line here"), (2, "same words in a line here"), (2, "same words in a line here"), (None, "no id at all"), (None, None), (3, None), (4, ""),
       (5, "x" * 50_000), (6, "one two three " * 5_000), (7, " \n \t"), (8, "Ünï — 漢字 🤗 ▁ <s>"), (9, "has <M> in it"), (10, "a <P"), (11, "S> b<"), (2**40, "1" * 9_000)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", k, "clash", "clash", "clash") for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n long, output string, base string, rank string")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


@pytest.mark.parametrize("name", ["op11_infill", "op13_importance"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df, result = queries.QUERIES[name](spark, FOLDER), con.execute(queries.SQL[name])
    columns = [d[0] for d in result.description]
    assert {d[0]: KINDS[str(d[1])] for d in result.description} == dict(df.dtypes)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(columns, result.fetchall())[0]


def by_hand(doc_id, text):
    """The transformation with a list of units."""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    key = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(key[8 * k : 8 * k + 8], 16) for k in range(4)]
    if text == "" or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 20 else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return len(units), form, len(prefix), len(middle), output


def test_infill_equals_brute_force():
    random.seed(11)
    units = regex.compile(f"({infill.UNIT})*")
    for k in range(3000):
        text = "".join(random.choice("ab <>PSM1é\n🤗") for _ in range(random.randint(0, 40)))
        assert infill.rewritten(k, text, units) == by_hand(k, text)


def test_infill_rebuilds_odd_texts(spark, odd, none):
    from pyspark.sql import functions as F
    found = infill.transform(odd).withColumn("again", infill.restored(F.col("form"), F.col("output"))).collect()
    assert sorted(tuple(r)[:6] for r in found if r.doc_id is not None) == sorted((i, *by_hand(i, t or "")) for i, t in ODD if i is not None)
    assert sorted(r.again for r in found) == sorted(t or "" for _, t in ODD)
    assert {r.form for r in found} == {"plain", "psm", "spm"} and infill.transform(none).count() == 0
    texts = spark.createDataFrame([(k, "".join(random.choice("ab <>PSM1é\n") for _ in range(30))) for k in range(400)], "doc_id long, text string")
    kept = infill.transform(texts).withColumn("again", infill.restored(F.col("form"), F.col("output")))
    assert kept.join(texts, "doc_id").where("again <> text").count() == 0


PATTERNS = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                                    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(text):
    """The stated patterns as they are."""
    def fits(kind, match):
        digits = re.sub("[^0-9]", "", match)
        if kind == 1:
            return all(int(p) <= 255 for p in match.split("."))
        if kind == 2:
            doubled = [int(d) if k % 2 == 0 else sum(map(int, str(2 * int(d)))) for k, d in enumerate(reversed(digits))]
            return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return kind == 0 or 9 <= len(digits) <= 15
    return sorted((m.start(), kind, m.end()) for kind, p in enumerate(PATTERNS) for m in p.finditer(text) if fits(kind, m[0]))


def test_plain_identifiers_equal_brute_force():
    random.seed(12)
    for _ in range(30_000):
        text = "".join(random.choice("a0.@1-+ 25(") for _ in range(random.randint(0, 40)))
        assert personal.identifiers(text) == plain_spans(text)
    for text in ("4111 1111 1111 1111", "4111111111111111 4111111111111111", "1.2.3.4.5.6.7.8", "256.1.1.1", "a@b.c@d.e_f@g.h", "001.002.003.0255"):
        assert personal.identifiers(text) == plain_spans(text)


def test_personal_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    found = queries.QUERIES["op12_personal"](spark, FOLDER).collect()
    written = lambda spans: ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in spans)
    assert len(found) == len(texts)
    for r in found:
        base = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(written(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in base) for n in range(4)]
        assert set(written(base).split(",")) <= set(r.spans.split(",")) if base else r.spans == ""


DISGUISED = [
    ("mail {} now", "john [at] example [dot] com", "email"), ("{}", "john.doe(at)mail.example.co.uk", "email"), ("reach {} thanks", "jane dot doe at example dot com", "email"),
    ("{}", "juan arroba ejemplo punto es", "email"), ("an {}!", "hans {ät} beispiel {punkt} de", "email"), ("write to {} soon", "jоhn@exаmple.com", "email"),
    ("{}", "j＠x．org", "email"), ("x {} y", "a​b@c​.de", "email"), ("{}", "jean arobase exemple point fr", "email"),
    ("call {} ok", "plus one five five five one two three four five six seven", "phone"), ("call {}", "+1 5O5 555 0l23", "phone"), ("{}", "+1 ٥٥٥ ٥٥٥ ٠١٢٣", "phone"),
    ("card {} end", " ".join(["four"] + ["one"] * 15), "card"), ("card {} end", "４１１１１１１１１１１１１１１１", "card"), ("{}", "4111–1111–1111–1111", "card"),
    ("karte {}", "vier " + "eins " * 14 + "eins", "card"), ("at {}.", "192 dot 168 dot 1 dot 1", "ip"), ("{}", "10[.]0[.]0[.]1", "ip"),
    ("{}", "john-at-example-dot-com", "email"), ("{}", "john_at_example_dot_org", "email"), ("{}", "johnATexampleDOTcom", "email"), ("{}", "john&#64;example&#46;com", "email"),
    ("{}", "john @ example . com", "email"), ("{}", "john%40example.com", "email"), ("card {} end", "4 one 1 one 1 one 1 one 1 1 1 1 1 1 1 1", "card"),
    ("call {} ok", "+1 five five five 555 zero one two three", "phone"), ("call {} ok", "+49 null drei null 555 0123 12", "phone"),
    ("ip {}", "one nine two dot one six eight dot one dot one", "ip"),
]


@pytest.mark.parametrize("around, secret, kind", DISGUISED)
def test_disguises_are_found_where_they_stand(around, secret, kind):
    for before in ("", "漢字 é ​", "one "):
        text = before + around.replace("{}", secret)
        base, spans = personal.scanned(text)
        at = text.index(secret)
        wanted = (at, personal.KINDS.index(kind), at + len(secret))
        assert wanted in spans and wanted not in base and set(base) <= set(spans)


@pytest.mark.parametrize("text", [
    "look at example.com", "we met at noon dot we left", "null eins zwei drei vier fünf sechs", "one two three four", "he is at home. Come", "un, deux, trois, quatre",
    "lunch @ noon.today", "the point is at stake", "version 1.2.3", "12–19 pages", "see [at] the end", "１２３", "Привет мир, как дела", "", "dot dot dot", "a stay-at-home day . Then 1 . 2",
    "WHAT a THATDOTthe", "100% at 5 . 6 . 7", "one 12 two 34 three 56",
])
def test_clean_texts_are_left_alone(text):
    assert personal.scanned(text) == ([], [])


def test_long_texts_take_linear_work(spark, odd, none):
    for unit in ("x", "1", "1 ", "1.", "a@", "+1(", " at ", "[at]", "a.", "("):
        assert len(personal.scanned(unit * 200_000)) == 2
    found = personal.find(odd)
    assert found.count() == len(ODD) and all(r.base == r.spans == [] for r in found.collect())
    assert personal.find(none).count() == 0


def test_crc_matrices_equal_zlib():
    random.seed(13)
    values = [bytes(random.randrange(256) for _ in range(random.choice([0, 1, 2, 3, 7, 8, 9, 300]))) for _ in range(2000)]
    assert importance.crcs(pa.array(values, pa.binary())).tolist() == [zlib.crc32(v) for v in values]
    assert importance.crcs(pa.array(values, pa.binary())[100:200]).tolist() == [zlib.crc32(v) for v in values[100:200]]
    assert len(importance.crcs(pa.array([], pa.binary()))) == 0


def test_words_and_runs():
    text = "Ab9 É-é ÀB\x00c_d\x7f漢字 x"
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    assert [w.decode() for w in importance.words(text)] == re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    assert importance.runs([b"a", b"b", b"c"], 3) == [b"a", b"b", b"c", b"a b", b"b c", b"a b c"]


@pytest.mark.parametrize("longest", [1, 2])
def test_importance_equals_brute_force(spark, odd, none, longest):
    random.seed(14)
    vocabulary = [f"w{k}" for k in range(60)]
    rows = [*((i, t) for i, t in ODD if i is not None), *((1000 + k, " ".join(random.choices(vocabulary, k=random.randint(0, 40)))) for k in range(150))]
    target = [(k, " ".join(random.choices(vocabulary[:10], k=12))) for k in range(20)] + [(99, None)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, rank long, score string")
    features = lambda t: [zlib.crc32(f) % 50 for f in importance.runs(importance.words(t or ""), longest)]
    s, t = (Counter(b for _, text in side for b in features(text)) for side in (rows, target))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 50) / ((s[b] + 1) * (t.total() + 50)))) for b in range(50)]
    expected = []
    for i, text in rows:
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in features(text))
        expected.append([i, len(features(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((-e[3], e[0], e[1], e[2]) for e, (_, text) in zip(expected, rows, strict=True) if len(importance.words(text or "")) >= 5)
    places = {e[1]: k + 1 for k, e in enumerate(fit[: len(fit) * 30 // 100])}
    found = importance.resample(docs, spark.createDataFrame(target, "item_id long, text string"), buckets=50, longest=longest, least_words=5, percent=30, seed=7).collect()
    assert sorted((r.doc_id, r.n_features, r.weight, r.score) for r in found) == sorted(map(tuple, expected))
    assert {r.doc_id: r["rank"] for r in found if r["rank"]} == places


def test_importance_on_odd_input(spark, odd, none):
    found = importance.resample(odd, none, least_words=5, percent=100).collect()
    ranked = sorted(r["rank"] for r in found if r["rank"])
    assert len(found) == len(ODD) and ranked == list(range(1, len(ranked) + 1)) and len(ranked) == sum(len(importance.words(t or "")) >= 5 for _, t in ODD)
    assert importance.resample(none, odd).count() == 0 and importance.resample(none, none).count() == 0
    assert np.all(importance.gains(np.zeros(5, np.int64), np.zeros(5, np.int64)) == 0)
