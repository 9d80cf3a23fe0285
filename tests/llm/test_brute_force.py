"""Registered queries against plain Python over the same rows, the tokenizers library, or held-out labels."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from sectora.llm import bpe, decontaminate, licenses, lm_scoring, near_dedup, pii, quality_rules, secret_scan, warc
from tests.conftest import SMOKE_DIR

QUERIES = entry.queries()
VOCABULARY = corpus_pipeline.public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect()}


def rows_of(spark, name):
    return {r[0]: r for r in QUERIES[name](spark, SMOKE_DIR).collect()}


def tokens(text):
    return text.encode().lower().split() + [b"\n"]


def test_lm_scoring(spark, documents):
    got = rows_of(spark, "op1_lm_scoring")
    held = {i for i in documents if zlib.crc32(str(i).encode()) % 7 == 2}
    counts = collections.Counter(t for i, x in documents.items() if i not in held for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    for i, text in documents.items():
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens(text))
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(tokens(text)), sum(counts[t] > 0 for t in tokens(text)), n)
        assert got[i].base_score == pytest.approx(base, rel=1e-9) and got[i].held_out == (i in held)
    assert sum(got[i].score for i in held) > sum(got[i].base_score for i in held)


def test_lm_probabilities_sum_to_one(spark, documents):
    """Over all predicted words and all words of every form class, with one unseen word in each."""
    counts = collections.Counter(t for x in documents.values() for t in tokens(x))
    table = [(lm_scoring._signed(lm_scoring.END), -1, counts.pop(b"\n"))] + [(*lm_scoring._described(w), c) for w, c in counts.items()]
    v = lm_scoring.Vocabulary(spark.createDataFrame(table, "token long, form int, c long"))
    w = lm_scoring.initial(v)
    h = np.random.default_rng(1).standard_normal((1, lm_scoring.WIDTH)).astype(np.float32)
    words = np.arange(len(v.words), dtype=np.int32)
    total = np.exp(lm_scoring.log_probabilities(v, w, np.repeat(h, len(words), 0), words)).sum()
    forms = np.arange(lm_scoring.FORMS, dtype=np.int32) + lm_scoring.VOCABULARY
    total += np.exp(lm_scoring.log_probabilities(v, w, np.repeat(h, len(forms), 0), forms)).sum()
    assert total == pytest.approx(1, abs=1e-3)
    # the shares inside a form class: (c + 1) of its words and 1 for an unseen one
    others = [(k, c) for t, k, c in table if t not in set(v.words.tolist())]
    for k in range(lm_scoring.FORMS):
        assert sum(c + 1 for f, c in others if f == k) + 1 == pytest.approx(v.form_n[k] + v.form_v[k] + 1)


def test_lm_gradient_by_differences(spark, documents):
    counts = collections.Counter(t for x in documents.values() for t in tokens(x))
    table = [(lm_scoring._signed(lm_scoring.END), -1, counts.pop(b"\n"))] + [(*lm_scoring._described(w), c) for w, c in counts.items()]
    v = lm_scoring.Vocabulary(spark.createDataFrame(table, "token long, form int, c long"))
    reader, w = lm_scoring.Reader(v), lm_scoring.initial(v)
    w = {k: x.astype(np.float64) for k, x in w.items()}
    texts = [reader.read(" ".join(documents[i].split()[:9]).encode())[1] for i in list(documents)[:3]]
    steps = {}
    trainer = lm_scoring.Trainer(v, w)
    trainer._update = lambda name, g, rows=slice(None): steps.setdefault(name, np.zeros_like(w[name])).__setitem__(rows, g)
    trainer.learn(texts)
    lanes = min(lm_scoring.LANES, len(texts))
    for name, at in (("wh", (2, 5)), ("wx", (1, 20)), ("wc", (0, 3)), ("bc", (1,)), ("bx", (40,))):
        losses = []
        for e in (1e-4, -1e-4):
            other = {k: x.copy() for k, x in w.items()}
            other[name][at] += e
            losses.append(-lm_scoring.score_texts(v, other, texts).sum() * math.log(10) / lanes)
        assert steps[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-4, rel=2e-2, abs=1e-5)


def test_words_cut_in_columns():
    """Whole columns, and slices of them, are cut as each text on its own."""
    draw = random.Random(3)
    texts = ["".join(draw.choices("aBäßñúé!)\x1c\x1f\x85\u2003ÉZ%. \t\n\x0b\x0c\r\x00", k=draw.randint(0, 14))) for _ in range(400)] + [None, "", " "]
    for kind in (pa.string(), pa.large_string()):
        for column in (pa.array(texts, kind), pa.array(texts, kind).slice(17, 300), pa.array([None, ""], kind), pa.array([], kind)):
            lengths, codes, words = lm_scoring.cut(column)
            cut = iter([words[c] for c in codes.tolist()])
            assert [[next(cut) for _ in range(n)] for n in lengths.tolist()] == [(t or "").encode().lower().split() for t in column.to_pylist()]
            assert len(set(words)) == len(words) and next(cut, None) is None
            assert lm_scoring.forms(words).tolist() == [lm_scoring.form(w) for w in words]
            assert lm_scoring._hashes(words).tolist() == [lm_scoring._described(w)[0] for w in words]


def test_lm_learns_from_every_window(spark):
    """Every word of a text of two windows is an input that takes a gradient."""
    table = [(lm_scoring._signed(lm_scoring.END), -1, 2)] + [(*lm_scoring._described(f"word{k}".encode()), 9) for k in range(40)]
    v = lm_scoring.Vocabulary(spark.createDataFrame(table, "token long, form int, c long"))
    trainer = lm_scoring.Trainer(v, lm_scoring.initial(v))
    steps = []
    trainer._update = lambda name, g, rows=slice(None): steps.extend(rows.tolist()) if name == "emb" else None
    trainer.learn([np.array([*range(1, 2 * lm_scoring.WINDOW), 0], np.int32)])
    assert set(steps) == set(range(2 * lm_scoring.WINDOW))


def test_lm_score_by_plain_steps(spark):
    """Texts of unlike lengths, in shared lanes, score as each alone, step by step in double precision."""
    table = [(lm_scoring._signed(lm_scoring.END), -1, 2)] + [(*lm_scoring._described(f"word{k}".encode()), 3 + k) for k in range(40)]
    v = lm_scoring.Vocabulary(spark.createDataFrame(table, "token long, form int, c long"))
    draw, size = np.random.default_rng(5), lm_scoring.WIDTH
    w = {k: (x + 0.3 * draw.standard_normal(x.shape)).astype(np.float32) for k, x in lm_scoring.initial(v).items()}
    words = [*range(1, 41), *range(lm_scoring.VOCABULARY, lm_scoring.VOCABULARY + lm_scoring.FORMS)]
    texts = [np.append(draw.choice(words, n), 0).astype(np.int32) for n in (0, 1, 90, 5, 0, 33, 17, 2)]
    # a lane's steps lie side by side
    assert all(x.T.flags.c_contiguous for x in lm_scoring.lanes(texts, 3))
    most, lm_scoring.SCORE_LANES = lm_scoring.SCORE_LANES, 3
    try:
        got = lm_scoring.score_texts(v, w, texts)
    finally:
        lm_scoring.SCORE_LANES = most

    def log_softmax(x):
        return x - x.max() - np.log(np.exp(x - x.max()).sum())

    for text, score in zip(texts, got, strict=True):
        h, before, total = np.zeros(size), 0, 0.0
        for word in text.tolist():
            x, g = w["emb"][before].astype(np.float64) @ w["wx"] + w["bx"], h @ w["wh"]
            z, r = (1 / (1 + np.exp(-(x + g)[k * size : (k + 1) * size])) for k in range(2))
            new = np.tanh(x[2 * size :] + r * g[2 * size :])
            h, before = new + z * (h - new), word
            known = word < lm_scoring.VOCABULARY
            k = v.class_of[word] if known else len(v.sizes) + word - lm_scoring.VOCABULARY
            total += log_softmax(h @ w["wc"] + w["bc"])[k]
            part = slice(v.starts[k], v.starts[k + 1]) if known else None
            total += log_softmax(h @ w["wo"][:, part] + w["bo"][part])[v.place[word]] if known else 0
        assert score == pytest.approx(total / math.log(10), rel=1e-5, abs=1e-4)


@pytest.mark.parametrize("size", [1.0, 200.0])
def test_lm_slopes_are_softmax_less_target(size):
    """Also where outputs are too large for an exponent."""
    draw = np.random.default_rng(2)
    x, at = (draw.standard_normal((50, 7)) * size).astype(np.float32), draw.integers(0, 7, 50)
    p = np.exp(x.astype(np.float64) - x.max(axis=1, keepdims=True))
    expected = (p / p.sum(axis=1, keepdims=True) - np.eye(7)[at]) / 4
    slopes, factor = lm_scoring._slopes(x.copy(), at, float(x.max()), np.float32(0.25))
    assert np.allclose(slopes * factor, expected, atol=1e-6)


def normal(text):
    return [w for w in map(decontaminate.normal, text.encode().split()) if w]


def test_decontamination_finds_every_exact_and_edited_item(spark, documents):
    items = {r.item_id: normal(r.text) for r in spark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r for r in QUERIES["op2_decontamination"](spark, SMOKE_DIR).collect()}
    vocab = collections.defaultdict(lambda: len(vocab) + 1)
    for i, text in documents.items():
        words = normal(text)
        for k, item in items.items():
            near = len(set(words) & set(item)) >= 0.5 * len(set(item))
            best = decontaminate.nearest([vocab[w] for w in item], [vocab[w] for w in words]) if near else (len(item), 0, 0)
            assert ((i, k) in got) == (best[0] <= decontaminate.allowed(len(item))), (i, k, best)
            if (i, k) in got:
                assert got[i, k].edits == best[0]


@pytest.mark.parametrize(("n", "edits"), [(8, 1), (15, 3), (30, 6), (60, 12)])
def test_decontamination_recall_at_the_full_distance(n, edits):
    assert decontaminate.recall(n, edits, 60) >= 0.95


@pytest.mark.parametrize("n", [120, 200, 300])
def test_decontamination_recall_of_long_items(n):
    assert decontaminate.recall(n, decontaminate.allowed(n), 60) >= 0.95


def test_decontamination_needs_the_least_of_a_group():
    """50 words with 10 edits may share 29 pairs, fewer than 49 words with 9 edits."""
    items = [[f"{name}{k}" for k in range(n)] for name, n in (("a", 49), ("b", 50), ("c", 59))]
    bench = decontaminate.Benchmark([(i, " ".join(x)) for i, x in enumerate(items)])
    assert any(g["members"].tolist() == [0, 1] for g in bench.groups)
    words = [bench.raw[w.encode()] for w in items[1]]
    words[3:49:5] = [0] * 10
    assert [f[:3] for f in bench.search([np.array([0] * 20 + words + [0] * 20, np.int64)])] == [(0, 1, 10)]


def test_bpe_equals_the_library(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    got = rows_of(spark, "op3_bpe")
    for i, text in documents.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_on_odd_texts():
    import random

    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(VOCABULARY), bpe.WordBpe(open(VOCABULARY, encoding="utf-8").read())
    pick = random.Random(5)
    odd = ["<|endoftext|>a<|startoftext|>", "'S'LL<|x", "ΟΔΟΣ Σ ΑΣ.", "İI ǅ ŉ", "\x1c\x1da\x85b\xa0c", "é ̸x", "a" * 500, "aaab" * 40, "日本 ١٢ ½"]
    odd += ["".join(pick.choice("aabcdeinothr'sstll 1!é\nÉß日 .-") for _ in range(pick.randint(0, 30))) for _ in range(3000)]
    for text, ids in zip(odd, own.encode_all([t.encode() for t in odd]), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == expected, text
        assert own.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_licenses(spark, documents):
    got = rows_of(spark, "op4_license_scan")
    said = {"Apache License": "Apache-2.0", "MIT License": "MIT", "GNU General Public License, version 3": "GPL-3.0", "CC BY-NC 4.0": "CC-BY-NC-4.0"}
    for i, text in documents.items():
        own = {name for words, name in said.items() if words in text} | ({"proprietary"} if "All rights reserved" in text else set())
        assert (got[i].origin in ("header", "file")) == bool(own)
        assert not own or got[i].licence in own


def test_every_licence_statement_is_told_in_a_comment(spark):
    """Each template, as one comment line and wrapped over lines, names its own licence; prose with its plain words none."""
    files = []
    for k, (_, text) in enumerate(licenses.TEMPLATES):
        cut = text.split()
        files += [(k, f"a{k}/x.py", f"# {text}\nx = 1\n"), (100 + k, f"b{k}/LICENSE", "\n".join(" ".join(cut[i : i + 12]) for i in range(0, len(cut), 12)))]
    files.append((300, "c/y.txt", "It is possible to have any purpose under the law which the author published with or without a fee."))
    got = {r.id: r.licence for r in licenses.scan(spark.createDataFrame(files, "id int, path string, text string")).collect()}
    for k, (name, _) in enumerate(licenses.TEMPLATES):
        assert got[k] == name and got[100 + k] == name, (name, got[k], got[100 + k])
    assert got[300] is None


def test_licence_cosine_and_inheritance(spark):
    apache = licenses.TEMPLATES[1][1]
    files = [
        (1, "repo/LICENSE", apache), (2, "repo/src/a.py", "x = 1"), (3, "repo/src/deep/b.py", "# Released under the MIT License\n" + "code " * 30),
        (4, "repo/other/COPYING", "Released under the MIT License"), (5, "repo/other/deep/er/c.py", None), (6, "else/d.py", "z"), (7, None, "z"), (8, "top.py", "z"),
    ]
    got = {r.id: r for r in licenses.scan(spark.createDataFrame(files, "id int, path string, text string")).collect()}
    assert {i: (r.licence, r.origin, r.licence_directory) for i, r in got.items()} == {
        1: ("Apache-2.0", "file", None), 2: ("Apache-2.0", "inherited", "repo"), 3: ("MIT", "header", None), 4: ("MIT", "file", None),
        5: ("MIT", "inherited", "repo/other"), 6: (None, "none", None), 7: (None, "none", None), 8: (None, "none", None),
    }
    # the cosine of one line, by hand: idf of the templates' words over all eight lines
    words = lambda t: [w for w in re.split(r"[^a-z0-9.]+|[.](?![0-9])", t.lower()) if w]
    lines = [line for *_, t in files for line in (t or "").split("\n")]
    df = collections.Counter(w for line in lines for w in set(words(line)))
    vocabulary = {w for _, t in licenses.TEMPLATES for w in words(t)}
    idf = {w: math.log((1 + len(lines)) / (1 + df[w])) + 1 for w in vocabulary}

    def vector(text):
        return {w: n * idf.get(w, max(idf.values())) for w, n in collections.Counter(words(text)).items()}

    def cosine(a, b):
        return sum(x * b.get(w, 0) for w, x in a.items()) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    text = "Licensed under the Apache License, Version 2.0, by us"
    found = licenses.scan(spark.createDataFrame([*files, (9, "x/y.py", text)], "id int, path string, text string")).where("id = 9").first()
    lines.append(text)
    df = collections.Counter(w for line in lines for w in set(words(line)))
    idf = {w: math.log((1 + len(lines)) / (1 + df[w])) + 1 for w in vocabulary}
    assert found.cosine == pytest.approx(max(cosine(vector(text), vector(t)) for _, t in licenses.TEMPLATES), abs=1e-5)


def test_arc_versions_and_errors():
    block = {v: warc._version_block(v, "x.arc") for v in (1, 2)}
    one = warc._arc_record(1, 5, "http://a/ b", b"<p>\r\n\r\n")
    two = warc._arc_record(2, 6, "http://c", b"")
    data = b"".join(x + b"\n" for x in (block[1], one, block[2], two))
    records = list(warc.parse_arc(data, "x"))
    assert [len(f) for _, f, _ in records] == [5, 10] and records[0][1][0] == "http://a/%20b"
    assert [warc._http(c)[1:] for *_, c in records] == [(b"<p>\r\n\r\n", 5, 7), (b"", 6, 0)]
    for broken in (data[:-5], one + b"\n", data.replace(b" 200 ", b" ", 2)):
        with pytest.raises(ValueError, match="x:"):
            list(warc.parse_arc(broken, "x"))


def test_quality_rules_drop_lines_that_many_documents_of_a_host_share(spark):
    names = [chr(97 + i // 10) + chr(97 + i % 10) for i in range(40)]  # digits would count as equal
    own = [f"alpha{x} beta{x} gamma{x} delta{x} epsilon{x} zeta{x} eta{x} theta{x} iota{x} kappa{x}" for x in names]
    common = "Accept ALL cookies, now 12!"
    docs = [(i, f"{t}\n{common}", "a") for i, t in enumerate(own)]
    docs += [(100 + i, f"{common}\nx{i} one two three four", "a") for i in range(3)] + [(200, f"{common}\nx one two three four", "b")]
    docs += [(300 + i, "one and the same text of more than ten words here for every copy", "a") for i in range(60)]
    got = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(docs, "doc_id long, text string, source string"), min_documents=20, share=0.05).collect()}
    assert all(got[i].kept and got[i].n_removed_words == 5 for i in range(40))
    # at a host where the line is common only half of the words are left
    assert got[100].n_removed_words == 5 and got[200].n_removed_words == 0
    # copies of one text count once, so their line stays
    assert all(got[300 + i].kept and got[300 + i].n_removed_words == 0 for i in range(60))


def spans_of(text, kinds):
    out = []
    for k, (name, pattern, check) in enumerate(kinds):
        out += [(m.start(), k, name, m.end()) for m in re.finditer(pattern, text) if check(m)]
    return ",".join(f"{n}:{s}:{e}" for s, _, n, e in sorted(out))


def test_secret_scan(spark, documents):
    kinds = [
        ("assign", r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 12),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
    ]
    got = rows_of(spark, "op7_secret_scan")
    for i, text in documents.items():
        said = spans_of(text, kinds)
        assert got[i].base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert set(filter(None, said.split(","))) <= set(got[i].spans.split(","))
    odd = "é password=token:abcdefghijkl TOKEN : 'Aa1+/_.=-Aa1+' api_key=short AKIA123 AKIAABCDEFGHIJKLMN ſecret=abcdefghijklmnop"
    assert secret_scan.spelled(secret_scan.base_spans(odd)) == spans_of(odd, kinds)


def test_guess_cost():
    cost = secret_scan.guess_cost
    assert cost("password") < 3 and cost("qwertyuiop") < 5 and cost("aaaaaaaaaaaa") < 4 and cost("19990101") < 5 and cost("abcabcabc") < 6
    assert cost("x9$Lq2!vB7zP") > 20 and cost("x9$Lq2!vB7zP" * 20) > cost("x9$Lq2!vB7zP")
    _, spans = secret_scan.all_spans("login pwd: x9$Lq2!vB7zP but pwd: password1 and the key is hidden")
    assert secret_scan.spelled(spans) == "guess:11:23"
    # brute force over all segmentations into single characters and words
    value = "xpassword7"
    assert cost(value) <= sum(secret_scan._alphabet(value) for _ in "x7") + math.log10(2) + 1e-9
    assert secret_scan.redacted("a token = 'abcdefghijkl1' b") == "a token = '[SECRET]' b"


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("DB_PASSWORD=Tr0ub4dor&3xQ!", "Tr0ub4dor&3xQ"), ("dbPassword: Kq9#vT2!mZ", "Kq9#vT2!mZ"),
        ("AWS_SECRET_ACCESS_KEY=wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"),
        ("Authorization: Bearer Zx81kQpLm20VbT7u", "Zx81kQpLm20VbT7u"), ("authorization: basic Zx81kQpLm20VbT7u", "Zx81kQpLm20VbT7u"),
        ("secret: password: x9$Lq2!vB7zP", "x9$Lq2!vB7zP"), ("log: user_pwd = 'x9$Lq2!vB7zP'", "x9$Lq2!vB7zP"), ("the db_password is x9$Lq2!vB7zP", "x9$Lq2!vB7zP"),
        ("compass: northwestern, author: alexandrina, tokenizer: sentencepiece", None), ("password-protected is extraordinary", None),
    ],
)
def test_secret_names_with_further_parts(text, value):
    _, spans = secret_scan.all_spans(text)
    assert [text[s:e] for s, k, e in spans if k == 3] == ([value] if value else [])


def test_secret_value_beyond_an_assignment():
    text = "a password: Sup3rSecretPw@2024! b token=abcdefghijkl1 c"
    base, spans = secret_scan.all_spans(text)
    assert secret_scan.spelled(base) == "assign:2:25,assign:34:53"
    assert secret_scan.spelled(spans) == "assign:2:25,guess:12:30,assign:34:53"
    assert secret_scan.redacted(text) == "a password: [SECRET] b token=[SECRET] c"


def test_secret_names_are_read_once():
    import time

    began = time.monotonic()
    for text in ("token_" * 100_000, "token " * 100_000 + ":", "token" + " " * 500_000 + "x", "pass:" * 100_000):
        secret_scan.all_spans(text)
    assert time.monotonic() - began < 20


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (c > "4") for i, c in enumerate(reversed(digits))) % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m[0])


def test_pii(spark, documents):
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    ]
    odd = ["a@b.c_d@e.f x@@y.z", "+1 555 123 4567 8+1 (((", "1.2.3.4.5.6.7.8 0000255.1.1.1 256.1.1.1", "4111 1111 1111 1111 é 4111-1111-1111-1111\x01+49 30 1234567"]
    texts = documents | {10**6 + i: t for i, t in enumerate(odd)}
    got = {r.doc_id: r for r in pii.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    for i, text in texts.items():
        said = spans_of(text, kinds)
        assert got[i].base_sha256 == hashlib.sha256(said.encode()).hexdigest(), text[:80]
        assert set(filter(None, said.split(","))) <= set(got[i].spans.split(","))
    more = {1: "my iban DE89 3704 0044 0532 0130 00", 2: "iban DE89 3704 0044 0532 0130 01", 3: "ssn 123-45-6789", 4: "part 123-45-6789"}
    got = {r.doc_id: r.spans for r in pii.scan(spark.createDataFrame(list(more.items()), "doc_id long, text string")).collect()}
    assert got == {1: "iban:8:35", 2: "", 3: "ssn:4:15", 4: ""}


def test_pii_plan_has_no_python(spark):
    plans = [f(spark.read.parquet(f"{SMOKE_DIR}/documents.parquet"))._jdf.queryExecution().executedPlan().toString() for f in (pii.scan,)]
    assert not any(word in p for p in plans for word in ("Python", "Pandas", "MapInArrow"))


def components(sets, percent=80):
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for j, k in collections.Counter(j for g in s for j in holders[g]).items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                a, b = sorted((top(i), top(j)))
                up[b] = a
        for g in s:
            holders[g].append(i)
    return {i: top(i) for i in sets}


def shingle_set(text, size):
    words = text.encode().lower().split()
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def test_near_dedup_chains_hubs_and_hard_groups(spark):
    """A chain of small steps, and a group around a text that isn't there, whose members are close but mostly not linked."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(150)]
    texts, words = [], list(base)
    for step in range(12):
        texts.append(" ".join(words))
        words[step * 12 : step * 12 + 4] = [f"new{step}x{k}" for k in range(4)]
    for member in range(120):
        copy = list(base)
        for at in rng.choice(150, int(rng.integers(2, 7)), replace=False):
            copy[at] = f"m{member}x{at}"
        texts.append(" ".join(copy))
    texts += [texts[3], texts[3].upper(), "two words", "Two  words", ""]
    docs = dict(enumerate(texts))
    got = {r.doc_id: r for r in near_dedup.groups(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4), size=4).collect()}
    sets = {i: shingle_set(t, 4) for i, t in docs.items()}
    expected = components(sets)
    assert {i: r.component_id for i, r in got.items()} == expected
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert len(set(expected.values())) > 5


def test_super_min_hash_estimates_with_less_variance_than_independent_slots():
    rng, errors = np.random.default_rng(1), []
    for _ in range(300):
        a = rng.integers(0, 2**63, 45, dtype=np.uint64)
        b = np.concatenate([a[5:], rng.integers(0, 2**63, 5, dtype=np.uint64)])
        one, other = near_dedup.super_min_hash([np.unique(a), np.unique(b)])
        errors.append(np.mean(one == other) - 0.8)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < math.sqrt(0.16 / near_dedup.SLOTS)


def test_quality_held_out_accuracy(spark):
    got = rows_of(spark, "op10_quality_knn")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMOKE_DIR}/labels.parquet").collect()}
    held = [i for i in got if got[i].held_out and i in labels]
    assert len(got) == 200 and all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert np.mean([got[i].predicted == labels[i] for i in held]) >= 0.9
    assert all(r.predicted == (r.score >= 0.7) for r in got.values())


def test_pipeline_is_its_stages(spark, documents):
    """The pipeline's documents: accepted, first of their group, without a benchmark item, secrets replaced."""
    got = rows_of(spark, "pipeline")
    accepted = {i for i, r in rows_of(spark, "op10_quality_knn").items() if r.predicted}
    groups = components({i: shingle_set(documents[i], 5) for i in sorted(accepted)})
    first = {i for i, c in groups.items() if i == c}
    leaked = {r.doc_id for r in QUERIES["op2_decontamination"](spark, SMOKE_DIR).collect()}
    assert set(got) == first - leaked
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    for i, row in got.items():
        assert list(row.ids) == library.encode(secret_scan.redacted(documents[i]), add_special_tokens=False).ids


PROSE = [
    "Your password is incorrect", "The token is automatically refreshed", "The secret is wonderful", "the passphrase is different now",
    "auth: disabled-by-default", "password: January2024!", "token: automatically generated", "The api key is mandatory; authentication is important.",
    "password: ${DB_PASSWORD_9}", "secret=<your-secret-token-here>", "the --password option", "see http://user:pass@host/ and https://example.com:8080/a@b",
]


@pytest.mark.parametrize("text", PROSE)
def test_prose_about_credentials_stays(text):
    assert secret_scan.redacted(text) == text


def test_a_thousand_prose_texts_keep_all_words():
    names = ["password", "The secret", "Our token", "a passphrase", "The API key", "Authorization", "my credential", "this pwd", "An access_key", "her passcode"]
    links = [" is ", ": ", " is now ", " = "]
    values = """unavailable mandatory confidential temporarily replaceable wonderful incorrect questionable untouchable alphabetically
        Distinguished ESSENTIAL well-protected hardly-ever-used überflüssig nécessaire intentionally misunderstood case-sensitive thirteen
        acknowledged communicated state-of-the-art straightforward overwhelming responsible""".split()
    texts = [f"{n}{link}{v} as of today." for n in names for link in links for v in values]
    assert len(texts) > 1000
    kept = [t for t in texts if secret_scan.redacted(t) == t]
    # an equals sign makes a long value an assignment by its form, which goes whatever it says
    assert {t for t in texts if t not in kept} <= {t for t in texts if " = " in t and secret_scan.base_spans(t)}


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ('password := "Tr0ub4dor&3xQ!"', "Tr0ub4dor&3xQ!"), ("password => 'Tr0ub4dor&3xQ!'", "Tr0ub4dor&3xQ!"), ("run --password Tr0ub4dor&3xQ!x now", "Tr0ub4dor&3xQ!x"),
        ("postgres://admin:Zx81kQpLm20VbT7u@db.host/x", "Zx81kQpLm20VbT7u"), ("password=\"Xk9$'Qz71!mPw\"", "Xk9$'Qz71!mPw"), ("pwd: Xk9$<Qz71!mPw</td>", "Xk9$<Qz71!mPw"),
        ('{"authorization": "Bearer Zx81kQpLm20VbT7u"}', "Zx81kQpLm20VbT7u"), ("The password is 'Xk9$Qz71!mPw'.", "Xk9$Qz71!mPw"),
    ],
)
def test_secrets_in_every_notation(text, value):
    assert secret_scan.redacted(text) == text.replace(value, "[SECRET]")


def plain_price(span, whole, rank):
    """log10 guesses of one span in one go, the cheapest of all kinds; infinite if it is of none."""
    one = math.log10(max(10, 26 * bool(re.search("[a-z]", whole)) + 26 * bool(re.search("[A-Z]", whole)) + 10 * bool(re.search("[0-9]", whole)) + 33 * (not whole.isalnum())))
    n, low, ways = len(span), span.lower(), []
    if n == 1:
        ways.append(one)
    for text in (low, low.translate(str.maketrans("013457@$!", "oieastasi"))):
        if 3 <= n <= 14 and text in rank:
            ways.append(math.log10(rank[text] + 1) + 0.5 * (text != span))
    if n >= 2 and len(set(span)) == 1:
        ways.append(one + math.log10(n))
    for size in range(2, 9):
        if n >= 2 * size and n % size == 0 and span == span[:size] * (n // size):
            ways.append(size * one + math.log10(n // size))
    if re.fullmatch(r"(19|20)\d\d", span):
        ways.append(math.log10(120))
    rows = ["`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz"]
    steps = [(a, b) for a, b in zip(low, low[1:])]
    if n >= 3 and all(any(a + b in r or b + a in r for r in rows) for a, b in steps):
        ways_of = [a < b for a, b in steps]
        ways.append(math.log10(47 * n) + 0.6 * (1 + sum(x != y for x, y in zip(ways_of, ways_of[1:]))))
    return min(ways, default=math.inf)


@pytest.mark.parametrize("value", ["xpassword7", "aaab1212", "qwert!2019", "P4ssw0rdAb", "abcabc7zz", "dragon1999", "zxcasdqwe1", "x9$Lq2!vB", "1234321aa", "adminadmin"])
def test_guess_cost_is_the_cheapest_of_all_segmentations(value, monkeypatch):
    monkeypatch.setattr(secret_scan, "wordly", lambda run: False)
    n = len(value)
    price = {(i, j): plain_price(value[i:j], value, secret_scan.RANK) for i in range(n) for j in range(i + 1, n + 1)}
    cheapest = math.inf
    for cuts in range(2 ** (n - 1)):
        ends = [0, *(k + 1 for k in range(n - 1) if cuts >> k & 1), n]
        cheapest = min(cheapest, sum(price[a, b] for a, b in zip(ends, ends[1:])))
    assert secret_scan.guess_cost(value) == pytest.approx(cheapest)


def test_words_are_ranked_by_the_corpus(spark):
    docs = spark.createDataFrame([(i, f"Zyrtqwx zyrtqwx common{' rarely' if i < 2 else ''} é{i}") for i in range(5)] + [(9, None)], "doc_id long, text string").repartition(3)
    rank = secret_scan.ranked_words(docs)
    assert rank["zyrtqwx"] > len(secret_scan.RANK) and rank["common"] < rank["zyrtqwx"] and "rarely" not in rank and rank["password"] == 1
    assert secret_scan.guess_cost("zyrtqwx", rank) < 3 < secret_scan.guess_cost("zyrtqwx")
    assert len(secret_scan.ranked_words(docs, most=1)) == len(secret_scan.RANK) + 1
    value = "Kq9#vT2!mZ"
    found = {r.doc_id: r for r in secret_scan.scan(spark.createDataFrame([(1, f"pwd: {value}"), (2, "pwd: none of it")], "doc_id long, text string")).collect()}
    assert found[1].spans == "guess:5:15" and found[1].guess_costs == [round(secret_scan.guess_cost(value), 3)] and found[2].n_guess == 0


@pytest.mark.parametrize("hosts", [20, 200])
def test_registered_limits_remove_a_line_in_a_tenth_of_a_hosts_documents(spark, hosts):
    """At a host of 50 and of 500 distinct texts, with the registered values; a line in two documents stays."""
    n = 50 if hosts == 20 else 500
    def letters(i):
        return "".join(chr(97 + int(d)) for d in str(i))
    docs = [(i, f"own words {' '.join(letters(i) + c for c in 'abcdefghijk')}" + ("\nSubscribe to our letter today" if i % 10 == 0 else "") + ("\nSeen here and there only" if i < 2 else ""), "h") for i in range(n)]
    got = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    assert all(got[i].n_removed_words == (5 if i % 10 == 0 else 0) and got[i].kept for i in range(n))


def test_short_items_are_found_exactly(spark):
    items = [(1, "What is dark energy?"), (2, "New York"), (3, "yes"), (4, "one two three four five six seven"), (5, "what is dark energy")]
    docs = [(1, "so: What is DARK energy, they ask"), (2, "in new york, yes!"), (3, "what is energy"), (4, "what is dark matter energy"), (5, "One two three four five six seven."), (6, "")]
    table, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.edits, r.first_word, r.last_word) for r in decontaminate.contaminated(table, bench).collect()}
    assert got == {(1, 1, 0, 1, 5), (1, 5, 0, 1, 5), (2, 2, 0, 1, 3), (2, 3, 0, 3, 4), (5, 4, 0, 0, 7)}
    assert {r.doc_id for r in decontaminate.clean(table, bench).collect()} == {2, 3, 4, 6}


def test_archive_files_are_closed_by_bytes(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "x" * 40_000) for i in range(30)] + [(99, "http://h/big", "y" * 300_000)], "page_id long, url string, html string").coalesce(1)
    warc.write_arc(pages, str(tmp_path / "arc"), file_bytes=200_000)
    import gzip

    sizes = [len(gzip.decompress(p.read_bytes())) for p in (tmp_path / "arc").glob("*.gz")]
    assert len(sizes) == 9 and sorted(sizes)[-2] < 210_000 and max(sizes) < 310_000
    warc.write_warc(warc.convert(spark, str(tmp_path / "arc")), str(tmp_path / "warc"), file_bytes=200_000)
    files = [gzip.decompress(p.read_bytes()) for p in (tmp_path / "warc").glob("*.gz")]
    assert all(f.startswith(b"WARC/1.0\r\nWARC-Type: warcinfo") for f in files)
    assert warc.read_warc(spark, str(tmp_path / "warc")).count() == 31
