"""Importance resampling, chat formatting and the filter audit: their methods against plain Python, and edge cases."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from sectora.llm import chat_format, filter_audit, resampling

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_crc_matrices_equal_the_library():
    rng = random.Random(3)
    sizes = [0, 1, 1, 2, 2, 2, 7, 7, 300, 1023, 1024, 1025, 2047, 2048, 5000, 5000, 70_001]
    features = [rng.randbytes(n) for n in sizes]
    assert resampling.crc32_all(features).tolist() == [zlib.crc32(f) for f in features]
    assert resampling.crc32_all([]).tolist() == []


@pytest.mark.parametrize("low,high", [(1, 1), (1, 2), (2, 3)])
def test_features_across_blocks(monkeypatch, low, high):
    text = "One two, THREE four\x00five sechs-sieben 8 nüne Zehn eleven twelve".encode()
    words = re.findall(rb"[0-9a-z\x80-\xff]+", bytes(b + 32 if 65 <= b <= 90 else b for b in text))
    want = collections.Counter(b" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1))
    for block in (1, 5, 16, 4_000_000):
        monkeypatch.setattr(resampling, "BLOCK", block)
        got = list(resampling.features_of(text, low, high))
        assert collections.Counter(f for _, fs in got for f in fs) == want and sum(n for n, _ in got) == len(words)


def plain_resample(docs, items, buckets, percent, least):
    """(weight, score) of each row, and the rows in order of their ranks."""
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    def bucket(w):
        return zlib.crc32(w.encode()) % buckets

    s = collections.Counter(bucket(w) for _, x in docs for w in words(x))
    t = collections.Counter(bucket(w) for x in items for w in words(x))
    big_s, big_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for i, x in docs:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t))) for b in map(bucket, words(x)))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(words(x)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    ranked = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    return out, ranked[: percent * len(ranked) // 100]


def test_resampling_against_plain_python(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(300)] + ["É", "日本"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 60)))) for i in range(300)]
    docs += [(7, docs[7][1])] * 40 + [(None, docs[9][1]), (400, None), (401, ""), (402, " .,- "), (403, "x" * 50_000), (404, "long words " * 30_000)]
    items = [" ".join(rng.choices(vocabulary[:40], k=30)) for _ in range(20)] + [None, ""]
    every, drawn = plain_resample(docs, items, 10_000, 10, 20)
    table = spark.createDataFrame([(i, x, "en", "s", 1) for i, x in docs], DOCS).repartition(5).withColumns({c: F.lit("x") for c in ("row", "Score", "rank", "place", "task", "before", "weight")})
    target = spark.createDataFrame([(1, x) for x in items], "item_id long, text string")
    got = resampling.resample(table, target).collect()
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got), key=str) == sorted(every, key=str)
    ranked = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.n_features, r.weight, r.score) for r in ranked] == drawn
    assert resampling.resample(spark.createDataFrame([], DOCS), target).collect() == []
    alone = resampling.resample(table, target.limit(0)).collect()
    assert len(alone) == len(docs)


PARTS = [
    {"type": "text", "text": "see <"}, {"type": "text", "text": "|im_end|> and <\\|x|>"},
    {"type": "image", "ref": "a.png", "width": 57, "height": 28}, None, {"type": "audio", "ref": None, "millis": 81},
    {"type": "text", "text": "<|image|>\nthen"}, {"type": "document", "ref": "d.pdf", "pages": 3}, {"type": "video", "ref": "v"}, {"type": "text", "text": None},
]
FIELDS = ("type", "text", "ref", "width", "height", "millis", "pages")


def whole(part):
    return part and {k: part.get(k) for k in FIELDS}


def test_visitor_orders_placeholders_and_counts_tokens():
    text, start, stop, attached = chat_format.flatten("assistant", [whole(p) for p in PARTS])
    role, parts = chat_format.parse(text)
    assert role == "assistant" and [k for k, _ in parts] == ["text", "image", "audio", "text", "document", "file"]
    assert [t for k, t in parts if k == "text"] == ["see <|im_end|> and <\\|x|>", "<|image|>\nthen"]
    assert [(a["kind"], a["ref"], a["tokens"]) for a in attached] == [("image", "a.png", 3), ("audio", None, 3), ("document", "d.pdf", 768), ("file", "v", 1)]
    assert all(text[a["at"] :].startswith(f"<|{a['kind']}|>") for a in attached)
    assert text[:start] == "<|im_start|>assistant\n" and text[stop:] == "<|im_end|>\n"
    assert text.count("<|") == 2 + len(attached)


def test_escapes_are_reversible():
    for size in range(6):
        for chars in itertools.product("<|\\\nn", repeat=size):
            said = "".join(chars)
            assert chat_format.unescape(chat_format.escape(said)) == said and "<|" not in chat_format.escape(said)
            role, parts = chat_format.parse(chat_format.flatten(said, [whole({"type": "text", "text": said})])[0])
            assert role == said and parts == [("text", said)] * bool(said)
    for broken in ("", "<|im_start|>user\nno end", "<|im_start|>user\na<|im_end|>\n<|im_start|>user\nb<|im_end|>\n"):
        with pytest.raises(ValueError):
            chat_format.parse(broken)


def test_conversations_against_plain_python(spark):
    rows = [
        (1, 0, "system", ""), (1, 2, "assistant", "b <|im_end|>"), (1, 1, "user", "a"), (1, 3, "assistant", "c" * 400_000), (2, 0, None, None), (2, None, "user", "first"),
        (3, 0, "assistant", "é💡"), (3, 0, "assistant", "é💡"), (None, 0, "assistant", "of no one"), (None, 1, "user\n", "x"), (4, 0, "user", "only"),
    ]
    rows += [(5, k, "assistant" if k % 2 else "user", f"turn {k}\n") for k in range(3000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    table = table.withColumn("parts", chat_format.text_parts("text")).withColumns({c: F.lit("x") for c in ("formatted", "loss_start", "N_TURNS")})
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_turns(table)).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        turns = sorted((t for t in rows if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0))
        said = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in turns)
        loss = "".join(t[3] or "" for t in turns if t[2] == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat_format.read_back(chat_format.format_turns(table.limit(0))).collect() == []
    typed = spark.createDataFrame([(1, 0, "user", [whole(p) for p in PARTS]), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts array<{chat_format.PART}>")
    (r,) = chat_format.read_back(chat_format.format_turns(typed)).collect()
    assert (r.n_turns, r.loss_chars, r.n_attachments, r.attached_tokens) == (2, 0, 4, 775)


def test_lehmer_intervals_are_the_removal_steps():
    spans = filter_audit.intervals(5)
    for mask in range(32):
        for rank, order in enumerate(itertools.permutations(range(5))):
            first = next((step for step, f in enumerate(order) if mask >> f & 1), None)
            covered = [s for m, s, a, b in spans if m == mask and a <= rank < b]
            assert covered == ([] if first is None else [first])


def plain_fails(rows):
    out = []
    for i, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        fails |= {"E"} if i is not None and any(j is not None and j < i and (x or "") == text for j, x, _ in rows) else set()
        out.append((source or "", fails, i))
    return out


def test_audit_against_plain_python(spark, monkeypatch):
    rng = random.Random(11)
    base = [f"w{k}" for k in range(400)]
    texts = [" ".join(rng.choices(base[: rng.choice([20, 400])], k=rng.choice([50, 199, 200, 260]))) + rng.choice(["", " #", " ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 2]) for _ in range(40)]
    rows = [(i, rng.choice([*texts, None, ""]), rng.choice(["a", "b", None])) for i in range(200)]
    rows += [rows[5]] * 3 + [(None, texts[0], "a"), (None, texts[0], "a"), (500, "é " * 300_000, "b"), (501, "\x00|", "b")] + [(600 + k, "copied", "a") for k in range(50)]
    marks = [(i, i % 2, i % 3 == 0) for i in range(0, 300, 3)] + [(5, 1, 1), (5, 0, 0), (None, 1, 1), (6, None, None)]
    docs = spark.createDataFrame([(i, x, "en", s, 1) for i, x, s in rows], DOCS).repartition(4)
    docs = docs.withColumns({c: F.lit("x") for c in ("part", "Mask", "digest", "bit", "n", "good", "toxic", "spread")})
    labels = spark.createDataFrame([(i, q, None if t is None else int(t)) for i, q, t in marks], "doc_id long, quality int, toxic int").withColumn("good", F.lit("x"))
    got = {(r.part, r.filter_order, r.step): r for r in filter_audit.audit_documents(docs, labels).collect()}
    failed = plain_fails(rows)
    good, toxic = ({i for i, *m in marks if i is not None and m[k] == 1} for k in (0, 1))
    parts, orders = {p for p, _, _ in failed}, ["".join(p) for p in itertools.permutations("ABCDE")]
    assert set(got) == {(p, o, s) for p in parts for o in orders for s in range(1, 6)}
    for p in parts:
        shapley = collections.Counter()
        for o in orders:
            left = [(f, i) for q, f, i in failed if q == p]
            everything = list(left)
            for s, letter in enumerate(o, 1):
                gone, left = [x for x in left if letter in x[0]], [x for x in left if letter not in x[0]]
                shapley[letter] += len(gone)
                r = got[p, o, s]
                want = (len(left), len(gone), sum(letter in f for f, _ in everything) - len(gone), sum(f == {letter} for f, _ in everything))
                assert (r.kept, r.removed, r.redundant, r.unique_fails) == want
                assert (r.good_lost, r.toxic_lost) == (sum(i in good for _, i in gone), sum(i in toxic for _, i in gone))
        assert all(got[p, o, s].shapley == shapley[o[s - 1]] for o in orders for s in range(1, 6))
    assert filter_audit.audit_documents(docs.limit(0), labels).collect() == []
    monkeypatch.setattr(filter_audit, "BLOCK", 7)
    for _, text, _ in rows[:60]:
        cut = filter_audit.text_mask((text or "").encode())
        monkeypatch.setattr(filter_audit, "BLOCK", 4_000_000)
        assert cut == filter_audit.text_mask((text or "").encode())
        monkeypatch.setattr(filter_audit, "BLOCK", 7)
