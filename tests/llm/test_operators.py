"""The text operators against brute force, libraries and round trips, and on odd input."""

import hashlib
import random
import re
import zlib
from functools import reduce
from itertools import combinations
from operator import or_
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plenaria.llm import boosting, lines, packing, passages, pieces, quality, queries, secrets, simhash, topk, toxicity, winnowing

FOLDER = "/root/testdata/sf0.001"
ODD = [(1, "same words in a line here"), (2, "same words in a line here"), (2, "same words in a line here"), (None, "no id at all"), (3, None), (4, ""),
       (5, "x" * 50_000), (6, "one two three " * 5_000), (7, " \n \t"), (8, "Ünï — 漢字 🤗 ▁ <s>")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", k, "clash", "clash") for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, digest string, fingerprint string")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def groups(pairs, n):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in pairs:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    return [find(i) for i in range(n)]


def test_winnow_equals_brute_force():
    random.seed(1)
    texts = ["".join(random.choice("abé漢 ") for _ in range(random.choice([0, 1, 5, 12, 13, 36, 200]))) for _ in range(80)]
    owner, hashes, at = winnowing.winnow(texts, 12, 24)
    for i, text in enumerate(texts):
        grams = winnowing.rolling(np.frombuffer(text.ljust(12, "\0").encode("utf-32-le"), "<u4"), 12).tolist() if text else []
        expected = []
        for start in range(max(1, len(grams) - 23) if grams else 0):
            window = grams[start : start + 24]
            best = start + max(j for j, h in enumerate(window) if h == min(window))
            if not expected or expected[-1][1] != best:
                expected.append((min(window), best))
        assert list(zip(hashes[owner == i].tolist(), at[owner == i].tolist(), strict=True)) == expected


def test_edited_texts(spark, odd, none):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    found = {r.doc_id: r for r in queries.QUERIES["op5_fingerprints"](spark, FOLDER).collect()}
    texts = [r.text or "" for r in rows]
    for i, (row, text) in enumerate(zip(rows, texts, strict=True)):
        after, half = texts[(i + 1) % len(texts)], len(text) // 2
        assert found[row.doc_id].edited_sha256 == hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()
    strange = winnowing.edited_likeness(odd).collect()
    assert len(strange) == len(ODD) and all(0 <= r.near_next <= 1 for r in strange)
    assert len({r.fingerprint for r in strange if r.doc_id in (1, 2)}) == 1
    assert winnowing.edited_likeness(none).count() == 0 and winnowing.fingerprints(odd).count() == len(ODD)


def test_components_equal_brute_force(spark, odd, none):
    random.seed(5)
    base = [[random.choice("abcdefghij") + str(random.randint(0, 99)) for _ in range(120)] for _ in range(12)]
    texts = []
    for words in base:
        for _ in range(8):
            copy = list(words)
            for _ in range(random.randint(0, 3)):
                copy[random.randrange(len(copy))] = "edit"
            texts.append(" ".join(copy))
    texts += ["", " ", "one", "One", "one two"]
    ids = random.sample(range(1000), len(texts))
    found = {r.doc_id: r for r in simhash.components(spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")).collect()}
    prints = [simhash.fingerprint(t) for t in texts]
    root = groups([(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2], len(texts))
    least = {g: min(ids[i] for i in range(len(texts)) if root[i] == g) for g in set(root)}
    assert all(found[ids[i]].component_id == least[root[i]] and found[ids[i]].fingerprint % 2**64 == prints[i] for i in range(len(texts)))
    assert simhash.components(odd).count() == len(ODD) and simhash.components(none).count() == 0
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 3, 5, 6, 8]


def test_one_of_each_with_repeated_ids(spark):
    random.seed(16)
    one, two, three = (" ".join(f"w{random.randint(0, 10**6)}" for _ in range(80)) for _ in range(3))
    kept = lambda rows: sorted(tuple(r) for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert kept([(1, one), (2, two), (2, one)]) == [(1, one), (2, two)]
    assert kept([(1, one), (1, two), (1, two), (3, three), (3, two), (4, three)]) == sorted([(1, one), (1, two), (3, three)])


def test_links_of_large_groups():
    random = np.random.default_rng(0)
    base = random.integers(0, 2**63, 300).astype(np.uint64)
    flip = lambda n: np.uint64(1) << random.integers(0, 64, n).astype(np.uint64)
    values = random.permutation(np.unique(np.concatenate([base, base ^ flip(300), base ^ flip(300) ^ flip(300)])))
    group = np.sort(random.integers(0, 3, len(values)))
    place = {int(v): i for i, v in enumerate(values)}
    a, b = simhash.links_of(values, group, 2)
    brute = [(i, j) for i in range(len(values)) for j in range(i) if group[i] == group[j] and (int(values[i]) ^ int(values[j])).bit_count() <= 2]
    assert groups([(place[int(x)], place[int(y)]) for x, y in zip(a, b, strict=True)], len(values)) == groups(brute, len(values))


def test_topk_ties_and_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [0.0, -1.0]), (4, None), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, []), (9, [2.0]), (None, [1.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = topk.search(vectors.where("vec_id = 0"), vectors, "vec_id", "embedding", 3).orderBy("rank").collect()
    assert [(r.rank, r.vec_id, r.score) for r in found] == [(1, 9, 1024 * 2048), (2, 1, 1024**2 + 512**2), (3, 2, 1024**2 + 512**2)]
    assert topk.search(vectors.where("false"), vectors, "vec_id", "embedding", 3).count() == 0
    assert topk.search(vectors, vectors.where("false"), "vec_id", "embedding", 3).count() == 0


def test_packing(spark, odd, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    definition, tokenizer = Path(path).read_text(), Tokenizer.from_file(path)
    found = packing.pack(odd, definition).collect()
    expected = []
    for i, text in ODD:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        expected += [(i, n, a, len(ids[a : a + 2048]), zlib.crc32(np.array(ids[a : a + 2048], "<u4").tobytes())) for n, a in enumerate(range(0, len(ids), 2048))]
    order = lambda rows: sorted(rows, key=str)
    assert order((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == order(expected)
    ends = {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(r.sequence_id, 0) == r.offset
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048 and packing.pack(none, definition).count() == 0


def test_fullest_combination_is_the_fullest():
    random.seed(4)
    for _ in range(60):
        items = [random.randint(1, 30) for _ in range(9)]
        counts = {x: items.count(x) for x in items}
        rest = sorted(items)[:-1]
        best = max(s for m in range(2 ** len(rest)) if (s := max(items) + sum(x for k, x in enumerate(rest) if m >> k & 1)) <= 40)
        chosen = packing.fullest(counts, 40)
        assert sum(x * n for x, n in chosen.items()) == best and all(n <= counts[x] for x, n in chosen.items())
        assert sum(n * t for c, t in packing.patterns(counts, 40) for n in c.values()) == len(items)


def test_sentencepiece_equals_the_library(spark, odd, none):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, library = Path(path).read_bytes(), sentencepiece.SentencePieceProcessor(model_file=path)
    random.seed(2)
    texts = ["", " ", "  ", "▁", "a" * 100, " lead", "trail ", *("".join(random.choice("ab e thing▁ \n\t  é漢🤗<s>01") for _ in range(random.randint(1, 90))) for _ in range(400))]
    merges = pieces.Merges(model)
    assert [np.frombuffer(b, "<u4").tolist() for b in merges.encode(texts)] == library.encode(texts)
    assert all(merges.agenda(merges.points[np.frombuffer(("▁" + t).encode("utf-32-le"), "<u4")]) is not None for t in texts[:9] if t)
    found = pieces.round_trip(odd, model).collect()
    assert len(found) == len(ODD) and all(r.agrees for r in found)
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(odd, model), model).collect()}
    assert all(back[i] == library.decode(library.encode(t or "")) for i, t in ODD)
    assert pieces.round_trip(none, model).count() == 0


def test_secret_spans_equal_python(spark, odd, none):
    assign = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
    random.seed(6)
    bits = ["password", "SECRET", "token", "api_key", "apikey", "=", ":", " ", '"', "'", "abc", "abcdef12", "AKIA", "ABCDEFGHIJKLMNOP12", "0123456789abcdef" * 2, "é漢🤗", "\n", "ſecret", "-", "=="]
    texts = ["".join(random.choice(bits) for _ in range(random.randint(0, 14))) for _ in range(300)]
    found = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        expected = sorted([(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6] + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
                          + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24])
        assert [tuple(s) for s in found[i].base] == expected, t
        assert set(map(tuple, found[i].base)) <= set(map(tuple, found[i].spans))
    assert secrets.scan(odd).count() == len(ODD) and secrets.scan(none).count() == 0


def test_weak_parts_need_their_complements(spark):
    access, key, url = "AKIA" + "A1" * 10, "aB3" * 13 + "d", "https://host.example.org/path"
    texts = [f"{access} and {key}", f"only {key}", f"{access} {'w ' * 300} {key}", f"see {url}", f"{access} {url} {key}", f"user=alice and password=abcdef9 at {url}"]
    found = {r.doc_id: [secrets.KINDS[s.kind] for s in r.spans] for r in secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert found == {0: ["access", "key"], 1: [], 2: ["access"], 3: [], 4: ["access", "endpoint", "key"], 5: ["user", "assign", "endpoint"]}


def test_keys_beside_marks(spark):
    access, key = "AKIA" + "A1" * 10, "aB3" * 13 + "d"
    texts = [f"AWS_ACCESS_KEY_ID={access}\nAWS_SECRET_ACCESS_KEY={key}\n", f"aws_access_key_id = {access}\naws_secret_access_key={key}", f'{{"id": "{access}", "SecretAccessKey": "{key}"}}',
             f"The id is {access}, the key is {key}.", f"{access}: {key}==", f"{access}:{key}", f"{access} {key}{key}", f"AWS_SECRET_ACCESS_KEY={key}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.spans if secrets.KINDS[s.kind] == "key"] for r in secrets.scan(docs).collect()}
    assert found == {0: [key], 1: [key], 2: [key], 3: [key], 4: [key + "=="], 5: [key], 6: [], 7: []}
    hidden = {r.doc_id: r.text for r in secrets.redacted(docs).collect()}
    assert not any(key in hidden[i] for i in range(6)) and hidden[0] == "AWS_ACCESS_KEY_ID=[SECRET]\nAWS_SECRET_ACCESS_KEY=[SECRET]\n"


def test_redaction_keeps_columns(odd, spark):
    assert sorted(map(str, secrets.redacted(odd).collect())) == sorted(map(str, odd.collect()))
    hidden = secrets.redacted(spark.createDataFrame([(1, "é password=abcdef123 end token: 0123456789abcdef0123456789abcdef.")], "doc_id long, text string")).first().text
    assert hidden == "é [SECRET] end [SECRET]"


def test_lines(spark, odd, none):
    line = " ".join(f"word{i}" for i in range(40))
    fuzzy = line.replace("word7 ", "Word7   ")
    texts = [(1, f"{line}\nunique first line of one"), (2, f"other text\n{fuzzy}\n\n\nend"), (3, line), (4, "short"), (5, "short\nshort"), (6, None)]
    found = {r.doc_id: (r.text, r.n_removed) for r in lines.dedup(spark.createDataFrame(texts, "doc_id long, text string"), counted=True).collect()}
    assert found == {1: (texts[0][1], 0), 2: ("other text\n\n\nend", 1), 3: ("", 1), 4: ("short", 0), 5: ("", 2), 6: (None, 0)}
    strange = lines.dedup(odd)
    assert strange.columns == odd.columns and strange.count() == len(ODD) and lines.dedup(none).count() == 0


def test_lines_with_changed_words(spark):
    random.seed(12)
    words = lambda n: ["".join(random.choice("abcdefghijklmnop") for _ in range(random.randint(3, 8))) for _ in range(n)]
    rows, near = [], 0
    for i in range(200):
        line = words([8, 10, 20, 50][i % 4])
        changed = [w if j != 3 else words(1)[0] for j, w in enumerate(line)]
        rows += [(2 * i, " ".join(line)), (2 * i + 1, " ".join(changed))]
        near += max(len(line[3]), len(changed[3])) <= 0.2 * max(len(rows[-1][1]), len(rows[-2][1]))
    solid = "".join(random.choice("漢字仮名交文行重複除去") for _ in range(60))
    rows += [(1000, solid), (1001, solid[:30] + "x" + solid[31:]), (1002, "| --- | --- |"), (1003, "| --- | -- |"), (1004, "page 12"), (1005, "page 13")]
    found = {r.doc_id: r.n_removed for r in lines.dedup(spark.createDataFrame(rows, "doc_id long, text string"), counted=True).collect()}
    assert near > 190 and sum(found[2 * i + 1] for i in range(200)) >= 0.97 * near
    assert not any(found[2 * i] for i in range(200)) and [found[i] for i in range(1000, 1006)] == [0, 1, 0, 0, 0, 0]


def test_line_sketches_and_pairs_equal_brute_force(spark):
    import xxhash
    random.seed(8)
    texts = ["".join(random.choice("ab cdé漢") for _ in range(n)) for n in (30, 60, 61, 200, 5000)] + ["five words are enough for it", "four words only here", "x" * 40, ""]
    words = spark.createDataFrame(list(enumerate(texts)), "i int, line string")
    found = {r.i: (r.bands, r.fingerprint) for r in lines.sketched(words, ["i"], "line", lines.WORDS).collect()}
    constants = [((k + 1) * lines.ODD & (1 << 64) - 1) >> 32 for k in range(lines.BANDS * lines.ROWS)]
    for i, text in enumerate(texts):
        told = {xxhash.xxh64(text[k : k + lines.GRAM].encode(), seed=42).intdigest() & lines.HALF for k in range(len(text) - lines.GRAM + 1)}
        long = len(re.findall(r"\w[^ ]*", text)) >= lines.WORDS or len(re.findall(r"\w", text)) >= lines.WORDS * lines.LETTERS
        if not long:
            assert found[i] == (None, None)
            continue
        least = [min(h ^ c for h in told) for c in constants]
        planes = [sum((x >> p & 1) << k for k, x in enumerate(least)) for p in range(lines.PLANES)]
        assert found[i][1] == planes and len(set(found[i][0])) == lines.BANDS
    # recall of the candidates: a changed word in lines of 8 to 60 words, at a similarity of 0.8 and more
    pairs = []
    while len(pairs) < 300:
        line = ["".join(random.choice("abcdefghijklmnop") for _ in range(random.randint(3, 8))) for _ in range(random.randint(8, 60))]
        changed = [w if random.random() > 0.12 else w[::-1] for w in line]
        x, y = " ".join(line), " ".join(changed)
        if x != y and sum(a != b for a, b in zip(x, y, strict=True)) <= 0.2 * len(x):
            pairs.append((x, y))
    rows = spark.createDataFrame([(2 * k + side, line) for k, pair in enumerate(pairs) for side, line in enumerate(pair)], "i int, line string")
    sketches = {r.i: (set(r.bands), r.fingerprint) for r in lines.sketched(rows, ["i"], "line", lines.WORDS).collect()}
    apart = lambda x, y: reduce(or_, (p ^ q for p, q in zip(x, y, strict=True))).bit_count()
    met = [bool(sketches[2 * k][0] & sketches[2 * k + 1][0]) and apart(sketches[2 * k][1], sketches[2 * k + 1][1]) <= lines.RADIUS for k in range(len(pairs))]
    assert sum(met) >= 0.9 * len(met)
    # pairs of lines that share a key, in length and sketch near enough, equal brute force over all pairs
    size = {i: len(line) for i, pair in enumerate(pairs) for i, line in ((2 * i, pair[0]), (2 * i + 1, pair[1]))}
    distinct = lines.sketched(rows, ["i"], "line", lines.WORDS).select(F.col("i").cast("long").alias("k1"), "bands", "fingerprint").join(
        rows.select(F.col("i").cast("long").alias("k1"), F.length("line").alias("size")), "k1")
    empty = spark.createDataFrame([], "node long, component long")
    members = lines.crowded(distinct)
    for radius in (12, lines.RADIUS):
        expected = {(i, j) for i, j in combinations(sorted(sketches), 2) if sketches[i][0] & sketches[j][0] and apart(sketches[i][1], sketches[j][1]) <= radius
                    and abs(size[i] - size[j]) <= 0.2 * max(size[i], size[j]) + 1e-9}
        assert expected and {(r.a, r.b) for r in lines.across(members, empty, radius, 0.8).collect()} == expected


def test_edits_equal_brute_force(spark):
    random.seed(9)

    def distance(x, y):
        row = list(range(len(y) + 1))
        for i, a in enumerate(x, 1):
            before, row = row, [i]
            for j, b in enumerate(y, 1):
                row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (a != b)))
        return row[-1]

    some = [["aa", "b", "cab", "abc", "", "äö"][random.randint(0, 5)] for _ in range(4000)]
    pairs = [("", ""), ("a", ""), ("a b a b", "a b"), ("a b", "a b a b"), ("a a a", "a a")]
    for n in range(300):
        x = some[n : n + random.randint(1, 9)]
        y = [w for w in x if random.random() > 0.2] if n % 2 else some[2 * n : 2 * n + random.randint(1, 9)]
        pairs.append((" ".join(x), " ".join(y)))
    rows = spark.createDataFrame([(x, y, m) for x, y in pairs for m in (0, 2, 5)], "x string, y string, most int")
    assert all(r.fits == (distance(r.x, r.y) <= r.most) for r in rows.withColumn("fits", lines.edits_fit("x", "y", F.col("most"))).collect())


def test_plain_words_are_encoded_in_few_texts():
    random.seed(21)
    letters = "abcxyzABCXYZàéÿßÀÞ"
    plain = [f"{''.join(random.choices(letters, k=random.randint(1, 9)))}{random.choice(['', '', '.', '***', '</', '<|'])}" for _ in range(3000)]
    other = ["don't", "x's", "İx", "K", "e\u0301", "<|endoftext|>", "漢字", "🤗", "v2.0", "", "a.b", "…", "\u0301"]
    texts = [" ".join(random.choices(plain + other, k=40)) for _ in range(200)] + ["", "\n", " a\n\nb "]
    words = packing.Words(Path(public_tokenizers.path("word_bpe_49k.json")).read_text())
    whole, asked = words.whole(texts), []
    words.whole, inner = lambda some: asked.extend(some) or inner(some), words.whole
    assert words.encode(texts) == whole and words.encode(texts) == whole and words.encode([]) == []
    assert set(asked) <= set(other)


def test_passages(spark, odd, none):
    random.seed(3)
    some = lambda n: [f"w{random.randint(0, 5000)}" for _ in range(n)]
    passage = some(80)
    edited = ["new" if i in (13, 31, 52) else w for i, w in enumerate(passage)]
    one = some(60)
    texts = [(1, some(100) + passage + some(50)), (2, some(30) + edited + some(10)), (3, some(200)), (4, passage), (5, one), (6, one), (7, None), (None, passage)]
    docs = spark.createDataFrame([(i, " ".join(t) if t else None) for i, t in texts], "doc_id long, text string")
    found = {(r.a, r.b): (r.a_start, r.a_end, r.b_start, r.b_end, r.similarity) for r in passages.shared(docs).collect()}
    assert found == {(1, 2): (100, 180, 30, 110, 1 - 3 / 80), (1, 4): (100, 180, 0, 80, 1.0), (2, 4): (30, 110, 0, 80, 1 - 3 / 80), (5, 6): (0, 60, 0, 60, 1.0)}
    assert passages.shared(odd).count() == 0 and passages.shared(none).count() == 0


def test_passages_with_a_gap_between(spark):
    random.seed(13)
    some = lambda n: [f"w{random.randint(0, 10**6)}" for _ in range(n)]
    texts, expected = [], set()
    for i, (size, gap, other) in enumerate([(60, 40, 40), (60, 80, 80), (60, 150, 150), (200, 120, 120), (60, 0, 60), (60, 10, 10)]):
        one, two = some(size), some(size)
        texts += [(2 * i, some(9) + one + some(gap) + two + some(9)), (2 * i + 1, some(5) + one + some(other) + two)]
        ends = [(9, 9 + size, 5, 5 + size), (9 + size + gap, 9 + 2 * size + gap, 5 + size + other, 5 + 2 * size + other)]
        expected |= {(2 * i, 2 * i + 1, *e, 1.0) for e in ends} if i < 5 else {(2 * i, 2 * i + 1, 9, 139, 5, 135, 1 - 10 / 130)}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts], "doc_id long, text string")
    assert {tuple(r) for r in passages.shared(docs).collect()} == expected


def test_passages_whose_parts_stand_elsewhere(spark):
    random.seed(14)
    some = lambda n: [f"w{random.randint(0, 10**6)}" for _ in range(n)]
    texts, expected = [], set()
    for base in range(0, 2000, 100):
        one, two = some(30), some(30)
        texts += [(base + i, some(9) + part + some(9)) for i, part in ((1, one), (2, two), (98, two), (99, one))]
        texts += [(base + 50, some(20) + one + two + some(5)), (base + 51, some(3) + one + two)]
        expected.add((base + 50, base + 51, 20, 80, 3, 63, 1.0))
    part = some(49)
    for i, more in ((5000, []), (5001, ["more"]), (5002, ["more"]), (5003, [])):
        texts.append((i, some(9) + part + more + some(9)))
    expected.add((5001, 5002, 9, 59, 9, 59, 1.0))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts], "doc_id long, text string")
    assert {tuple(r) for r in passages.shared(docs).collect()} == expected


def test_passages_with_many_edits(spark):
    random.seed(15)
    some = lambda n: [f"w{random.randint(0, 10**6)}" for _ in range(n)]
    cases = [(54, {4}), (54, {49}), (51, {2}), (51, {48}), (52, {3, 48}), *((120, set(range(n - 1, 120, n))) for n in (6, 7, 8, 10)),
             *((n, set(random.sample(range(3, n - 3), int(0.18 * n)))) for n in (100, 150, 200) for _ in range(6))]
    texts = []
    for i, (n, places) in enumerate(cases):
        passage = some(n)
        texts += [(2 * i, some(30) + passage + some(30)), (2 * i + 1, some(40) + ["new" if j in places else w for j, w in enumerate(passage)] + some(7))]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts], "doc_id long, text string")
    found = {}
    for r in passages.shared(docs).collect():
        assert r.b == r.a + 1 and r.a % 2 == 0 and r.similarity >= 0.8 and r.a_start >= 30 and r.a_end <= 30 + cases[r.a // 2][0]
        found[r.a // 2] = max(found.get(r.a // 2, 0), r.a_end - r.a_start)
    assert set(range(9)) <= set(found) and len(found) >= 0.9 * len(cases)
    assert all(found[i] == cases[i][0] for i in (0, 1, 2, 3)) and all(found[i] >= 110 for i in (5, 6, 7, 8))


def test_passages_whose_seeds_stand_in_the_same_other_documents(spark):
    """Every seed of an edited passage also stands in an earlier and in a later document; its own documents are linked."""
    random.seed(22)
    some = lambda n: [f"w{random.randint(0, 10**6)}" for _ in range(n)]
    texts, expected = [], {}
    for base in range(0, 400, 100):
        passage = some(60)
        parts = [passage[i : i + 16] for i in range(0, 60, 12)]
        mixed = [w for part in parts for w in part + some(30)], [w for part in parts[::-1] for w in some(30) + part]
        edited = ["new" if i in (12, 36) else w for i, w in enumerate(passage)]
        texts += [(base, mixed[0]), (base + 1, some(20) + passage + some(9)), (base + 2, some(7) + edited + some(30)), (base + 3, mixed[1])]
        texts += [(base + 4, mixed[0] + some(3))]
        expected[base + 1, base + 2] = (20, 80, 7, 67, 1 - 2 / 60)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts], "doc_id long, text string")
    found = {(r.a, r.b): (r.a_start, r.a_end, r.b_start, r.b_end, r.similarity) for r in passages.shared(docs).collect()}
    assert {p: found.get(p) for p in expected} == expected
    assert set(found) == {*expected, *((base, base + 4) for base in range(0, 400, 100))}


def test_passages_of_all_pairs(spark):
    """All pairs of documents that share a passage have a row, copies and other spellings of a text too, not only the first and the last."""
    random.seed(41)
    some = lambda n: [f"w{random.randint(0, 10**6)}" for _ in range(n)]
    one, two = some(60), some(70)
    texts, at = [], {}
    for i in range(6):
        before = some(10 + i)
        own = [f"n{i}" if j == 20 + 3 * i else w for j, w in enumerate(two)]
        texts.append((i, " ".join(before + one + some(70) + own)))
        at[i] = len(before), len(before) + 130
    texts += [(10, texts[0][1]), (11, texts[0][1]), (12, texts[3][1].upper())]
    at |= {10: at[0], 11: at[0], 12: at[3]}
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    found = {}
    for r in passages.shared(docs).collect():
        found.setdefault((r.a, r.b), []).append((r.a_start, r.a_end, r.b_start, r.b_end, r.similarity))
    for a, b in combinations(sorted(at), 2):
        size = [len(dict(texts)[i].split()) for i in (a, b)]
        same = a in (0, 10) and b in (10, 11) or (a, b) == (3, 12)
        ends = [(0, size[0], 0, size[1], 1.0)] if same else [(at[a][0], at[a][0] + 60, at[b][0], at[b][0] + 60, 1.0), (at[a][1], at[a][1] + 70, at[b][1], at[b][1] + 70, 1 - 2 / 70)]
        assert sorted(found.pop((a, b))) == ends, (a, b)
    assert not found


def test_passages_with_repeated_parts(spark):
    """Each place of a part that comes several times is in a row, without a row for each with each; memory stays small."""
    random.seed(42)
    some = lambda n: [f"w{random.randint(0, 10**6)}" for _ in range(n)]
    part = some(60)
    texts = {1: some(5) + part + some(30), 2: part + some(50) + part + some(70) + part, 3: ["so"] * 200 + some(9), 4: some(7) + ["so"] * 330,
             5: some(5) + ["la"] * 59 + some(5), 6: some(7) + ["la"] * 52 + some(3)}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    rows = passages.shared(docs).collect()
    assert sorted((r.a_start, r.a_end, r.b_start, r.b_end) for r in rows if (r.a, r.b) == (1, 2)) == [(5, 65, 0, 60), (5, 65, 110, 170), (5, 65, 240, 300)]
    so = [r for r in rows if (r.a, r.b) == (3, 4)]
    assert set().union(*(range(r.b_start, r.b_end) for r in so)) == set(range(7, 337)) and len(so) < 5
    assert {(r.b_start, r.b_end) for r in rows if (r.a, r.b) == (5, 6)} == {(7, 59)} and {(r.a, r.b) for r in rows} == {(1, 2), (3, 4), (5, 6)}


def test_diagonals_and_covering_equal_brute_force():
    random.seed(43)
    for most in (7, 10**6):
        for _ in range(60):
            u, v = ([random.randint(0, 3) for _ in range(random.randint(1, 25))] for _ in "uv")
            both = sorted({*u} & {*v})
            if both:
                runs = passages.diagonals(*([np.array([i for i, c in enumerate(t) if c == s]) for s in both] for t in (u, v)), most)
                met = {(i, j) for i, c in enumerate(u) for j, e in enumerate(v) if c == e}
                assert sorted((x + i, x + d + i) for x, d, n in runs.tolist() for i in range(n)) == sorted(met)
                assert all((x - 1, x + d - 1) not in met and (x + n, x + d + n) not in met for x, d, n in runs.tolist())
                kept = passages.covering(runs)
                assert {x + i for x, _, n in kept for i in range(n)} == {x for x, _ in met} and {x + d + i for x, d, n in kept for i in range(n)} == {y for _, y in met}


def test_lines_meet_by_key_and_number_alone(spark, monkeypatch):
    """Band keys are dealt out once, with no more than a line's number, and only texts of lines in pairs are shuffled."""
    random.seed(23)
    some = [" ".join(f"w{random.randint(0, 10**6)}" for _ in range(12)) for _ in range(40)]
    docs = spark.createDataFrame([(i, "\n".join([some[i], some[i // 2] + " more", f"own {i}"])) for i in range(40)], "doc_id long, text string")
    plans, kinds = [], []
    store, keep = lines.stored, lines.checkpoint

    def seen(df, then):
        found = then(df)
        kinds.append(tuple(df.columns))
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return found
    monkeypatch.setattr(lines, "stored", lambda df: seen(df, store))
    monkeypatch.setattr(lines, "checkpoint", lambda df: seen(df, keep))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        removed = {r.doc_id: r.n_removed for r in lines.dedup(docs, counted=True).collect()}
    finally:
        spark.conf.set(limit, before)
    # some[i] and its copies with one word more are one group for i < 20, of three places
    assert sum(removed.values()) == 40
    key = plans[kinds.index(("key", "id"))]
    assert "fingerprint" not in key.partition("RepartitionByExpression")[2].partition("\n")[0] and key.count("RepartitionByExpression [key") == 2
    judged = [p for p, k in zip(plans, kinds, strict=True) if k == ("a", "b") and "levenshtein" in p]
    assert len(judged) == 2 and all("might_contain" in p for p in judged)


def test_first_links_join_lines_and_shuffles_are_freed(spark, monkeypatch):
    """Lines that differ a little are linked through the smallest line of their keys, so the second look has none of their pairs."""
    random.seed(41)
    line = " ".join(f"w{random.randint(0, 10**6)}" for _ in range(40))
    docs = spark.createDataFrame([(i, f"{line} x{i}") for i in range(30)], "doc_id long, text string")
    name, judged, freed = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", [], []
    judge, store = lines.verified, lines.stored

    def seen(pairs, *more):
        judged.append((pairs.where("a < b").count(), pairs.count()))
        return judge(pairs, *more)

    def kept(df):
        freed.append(spark.conf.get(name))
        return store(df)
    monkeypatch.setattr(lines, "verified", seen)
    monkeypatch.setattr(lines, "stored", kept)
    before = spark.conf.get(name)
    assert sum(r.n_removed for r in lines.dedup(docs, counted=True).collect()) == 29
    assert judged[0][0] == judged[0][1] >= 29 and judged[1][1] == 0
    assert set(freed) == {"true"} and spark.conf.get(name) == before


def test_chains_and_alignment_equal_brute_force():
    random.seed(9)
    for _ in range(40):
        met = sorted({(random.randint(0, 60), random.randint(0, 60)) for _ in range(12)})
        best = {}
        for i, (x, y) in enumerate(met):
            before = [best[j] - passages.GAP * (x - u + y - v) for j, (u, v) in enumerate(met[:i]) if u < x and v < y]
            best[i] = 6 + max([0.0, *before])
        chain = passages.chains([m[0] for m in met], [m[1] for m in met])[0]
        score = 6 * len(chain) - passages.GAP * sum(met[chain[-1]][s] - met[chain[0]][s] for s in (0, 1))
        assert score == pytest.approx(max(best.values())) and all(met[a][0] < met[b][0] and met[a][1] < met[b][1] for a, b in zip(chain, chain[1:], strict=False))
    assert passages.alignment(list("abcdefghij"), list("acdefghij"), [2], [1]) == 0.9 and passages.alignment(list("abc"), list("xyz"), [], []) == 0.0
    assert passages.distance(list("kitten"), list("sitting")) == 3 and passages.distance([], ["a"]) == 1


def test_trees_and_classifiers(spark, odd, none):
    random = np.random.default_rng(1)
    x = random.normal(size=(800, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    model = boosting.fit(x[:600], y[:600])
    assert ((model.score(x[600:]) >= 0.5) == y[600:]).mean() > 0.9
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    for name, label in (("op2_quality", "quality"), ("op10_toxicity", "toxic")):
        found = queries.QUERIES[name](spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out").select("predicted", label).collect()
        assert np.mean([r.predicted == r[label] for r in found]) > 0.9
    model = quality.fit(docs, labels)
    kept = quality.accepted(odd, model)
    assert kept.columns == odd.columns
    assert odd.select(quality.score(model, F.col("text")).alias("s")).where("s between 0 and 1").count() == len(ODD)
    assert quality.accepted(none, quality.fit(none, labels)).count() == 0
    assert toxicity.fit(none, labels) is None
    assert odd.select(toxicity.score(None, F.col("text")).alias("s")).where("s = 0").count() == len(ODD)
    small = toxicity.train([toxicity.hashed(t) for t in (["good", "day"], ["vile", "day"])] * 20, np.array([0.0, 1.0] * 20))
    assert len(toxicity.scores(small, [None, "", "vile"])) == 3 and toxicity.language("der und die".split()) == 2


def test_toxicity_is_learnt_from_all_labelled_rows(spark):
    """More labelled rows than one task trains on, or than were once drawn of a class, all count; one part is as train()."""
    words = ["good day to all members", "a fair and open debate", "the vote is on the motion"]
    rows = [(i, f"{words[i % 3]} word{i % 7}" + (f" vile{i % 2}" if i % 4 == 0 else "")) for i in range(9_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    other = spark.createDataFrame([(-1, 1), (1, None), (None, 1), (2, 5)], "doc_id long, toxic int")
    clean = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_label"))
    named = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    parts = toxicity.packed(toxicity.labelled(named, clean, 9_000), clean, 4)
    found = [toxicity.unpacked(part) for part in ({n: v for n, v in r.asDict().items() if n != "part"} for r in parts.collect())]
    assert sorted(i for p in found for i in p[3]) == list(range(9_000)) and sum(p[1].sum() for p in found) == 2_250
    texts = {int(i): t for p in found for i, t in zip(p[3], p[0], strict=True)}
    assert all((texts[i] == toxicity.hashed(t.split())).all() for i, t in rows[:50])
    model = toxicity.fit(docs, labels.unionAll(other), rows=2_000)
    scored = np.array(toxicity.scores(model, [t for _, t in rows])) >= 0.5
    assert (scored == [i % 4 == 0 for i, _ in rows]).all()
    few, y = [t for _, t in rows[:400]], np.array([float(i % 4 == 0) for i in range(400)])
    used = [i for i in range(400) if zlib.crc32(f"calibrate {i}".encode()) % 5]
    whole, one = toxicity.fit(docs.where("doc_id < 400"), labels), toxicity.train([toxicity.hashed(few[i].split()) for i in used], y[used])
    assert np.allclose(whole.embedding, one.embedding, atol=1e-3) and np.allclose(whole.output, one.output, atol=1e-3)
    # all held-out rows are counted, one by one or by steps
    exact, steps = (toxicity.margins(one, parts, n, True) for n in (1, toxicity.EXACT + 1))
    held = sum(zlib.crc32(f"calibrate {i}".encode()) % 5 == 0 for i in range(9_000))
    assert len(exact) == held == steps.zeros.sum() + steps.ones.sum() and (exact.ones.sum(), held) == (steps.ones.sum(), held)


def test_thresholds_of_many_rows_are_those_of_single_rows(spark):
    """However many rows set them, thresholds are the same; only rows near them are gathered one by one."""
    random.seed(31)
    marks = ["zebra", "the", "der", "le", "el"]
    rows = [(i, " ".join([marks[i % 5], *(f"w{random.randint(0, 300)}" for _ in range(random.randint(1, 12)))]), int(random.random() < 0.3)) for i in range(4_000)]
    docs = spark.createDataFrame(rows, "_id long, _text string, _label int").repartition(3)
    clean = docs.select("_id", "_label")
    parts = toxicity.packed(toxicity.labelled(docs.select("_id", "_text"), clean, len(rows)), clean, 3)
    model = toxicity.train([toxicity.hashed(t.split()) for _, t, _ in rows[:1_000]], np.array([float(y) for *_, y in rows[:1_000]]))
    for held in (True, None):
        found = {}
        for n in (1, toxicity.EXACT + 1):
            found[n] = toxicity.margins(model, parts, n, held)
            toxicity.calibrate(model, found[n])
            found[n] = len(found[n]), found[n].zeros.sum(), found[n].ones.sum(), model.thresholds.tolist()
        (one, *exact), (many, *steps) = found.values()
        assert steps == exact and many < one


def test_texts_of_one_id_keep_their_own_lines(spark):
    """Texts of one id whose 32-bit hashes are equal are still told apart, with and without an id."""
    line, seen, texts = "the same line of boilerplate that stands in many documents of this table", {}, []
    for k in range(0, 400_000, 20_000):
        found = spark.range(k, k + 20_000).select(F.format_string(line + "\nnumber %d", "id").alias("t")).select("t", F.hash("t").alias("h")).collect()
        texts += [(seen[r.h], r.t) for r in found if r.h in seen]
        seen |= {r.h: r.t for r in found}
        if texts:
            break
    one, two = texts[0]
    for i in (1, None):
        rows = spark.createDataFrame([(0, line), (i, one), (i, two)], "doc_id long, text string")
        kept = [r.text for r in lines.dedup(rows).collect()]
        assert sum(one.split("\n")[1] in t for t in kept) == 1 and sum(two.split("\n")[1] in t for t in kept) == 1 and sum(line in t for t in kept) == 1


def test_one_of_each_with_clashing_names(spark):
    names = ["_id", "_digest", "_row", "_text", "_number", "row", "digest", "number", "root", "n"]
    rows = [(i, "a text of some words that is long enough to count here", *[f"{n}{i}" for n in names]) for i in (1, 2, 2)]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))).collect()
    assert [tuple(r)[:3] for r in kept] == [(1, rows[0][1], "_id1")]


@pytest.mark.parametrize("name", ["op10_toxicity", "op12_personal", "op13_importance", "op11_infill"])
def test_queries_run_from_a_foreign_folder(tmp_path, name):
    """Workers started elsewhere, without the package on their path, still run the query."""
    import subprocess
    import sys
    code = (f"import sys; sys.path.insert(0, {str(Path(__file__).resolve().parents[2])!r}); import __spark_entry__ as e; from plenaria.session import local_session; s = local_session('far', 2); "
            f"print('rows', e.queries()[{name!r}](s, {FOLDER!r}).count())")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300, env={k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"})
    assert "rows 200" in done.stdout, done.stderr[-2000:]
