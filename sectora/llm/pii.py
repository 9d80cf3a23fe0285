"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust their score.

DataFrame functions only. Each kind's expression wraps its matches in a mark that the text can't hold; splitting at
the mark gives gaps and matches in turn, and a running sum of their lengths over a document gives the positions
in code points. Only the matches are exploded and shuffled (once, by row), never texts.

Expressions are possessive or bounded, so matching needs no deep stack and no repeated scans on very long texts.

Kinds: ``email, ip, card, phone`` (always reported when their checks hold), ``iban`` (mod-97) and ``ssn`` (needs a
context word). A score is the prior of its kind, plus ``CONTEXT_GAIN`` if one of the kind's context words stands
within ``NEAR`` characters, up to the neighbouring match of that kind; spans of the last two kinds need
``LEAST_SCORE``.

Edge cases: null and empty texts have no spans. Repeated rows give equal rows, also without a doc_id. Matches that
fail a check are dropped and their text is not searched again. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEAR, CONTEXT_GAIN, LEAST_SCORE = 40, 0.35, 0.6
KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
BASE = 4

# The proposing expressions. A run that can't start a match isn't tried again from its middle.
PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
}
#: What a text must hold for the expression to be worth running.
HINT = {"email": "@", "ip": ".", "card": None, "phone": "+", "iban": None, "ssn": "-"}
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.85, "ssn": 0.4}
CONTEXT = {
    "email": r"mail|contact|correo|courriel|kontakt|write|@",
    "ip": r"\bip\b|address|host|server|client|login|adresse",
    "card": r"card|visa|master|amex|credit|debit|payment|tarjeta|carte|karte",
    "phone": r"phone|call|tel|mobile|fax|whatsapp|contact|handy|móvil",
    "iban": r"iban|account|bank|konto|compte|cuenta|bic|swift",
    "ssn": r"ssn|social security|tax|taxpayer",
}
MARK = "\u0001"


def _proposals(text: Column, kind: str) -> Column:
    """array<struct<kind, k, gap, hit, before, after>> of one kind's matches, in order."""
    # the mark itself becomes another character that no expression contains
    marked = F.regexp_replace(F.translate(text, MARK, "\u0002"), PATTERN[kind], f"{MARK}$0{MARK}")
    if HINT[kind]:
        marked = F.when(F.contains(text, F.lit(HINT[kind])), marked).otherwise(F.lit(""))
    parts = F.split(marked, MARK)
    # gap, match, gap, match, ..., gap
    hits = F.transform(
        F.filter(F.transform(parts, lambda part, i: F.struct(i.alias("i"), part.alias("part"))), lambda x: x["i"] % 2 == 1),
        lambda x: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            x["i"].alias("k"),
            F.char_length(parts[x["i"] - 1]).cast("long").alias("gap"),
            x["part"].alias("hit"),
            F.right(parts[x["i"] - 1], F.lit(NEAR)).alias("before"),
            F.left(parts[x["i"] + 1], F.lit(NEAR)).alias("after"),
        ),
    )
    return F.when(F.size(parts) > 1, hits)


def luhn(digits: Column) -> Column:
    """Luhn checksum of a digit string: every second digit from the right counts twice, digit sum."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """The ISO 7064 check of an IBAN without spaces: first four characters to the end, letters as 10..35."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        c = F.substring(turned, i, F.lit(1))
        value = F.ascii(c)
        return F.when(value < 58, (rest * 10 + value - 48) % 97).otherwise((rest * 100 + value - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _valid() -> Column:
    hit = F.col("hit")
    digits = F.regexp_replace(hit, "[^0-9]", "")
    n = F.length(digits)
    part = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    code = F.replace(hit, F.lit(" "), F.lit(""))
    return (
        F.when(F.col("kind") == 0, F.lit(True))
        .when(F.col("kind") == 1, F.forall(part, lambda p: (F.length(p) <= 3) & (F.left(p, F.lit(3)).cast("int") <= 255)))
        .when(F.col("kind") == 2, F.when(n.between(14, 19), luhn(digits)).otherwise(False))
        .when(F.col("kind") == 3, n.between(10, 15))
        .when(F.col("kind") == 4, F.when(F.length(code).between(15, 34), mod97(code)).otherwise(False))
        .otherwise(F.lit(True))
    )


def _by_kind(table: dict[str, object]) -> Column:
    """The kind's value, as a column."""
    return F.element_at(F.array(*[F.lit(table[k]) for k in KINDS]), F.col("kind") + 1)


def spans(docs: DataFrame) -> DataFrame:
    """``row, doc_id, kind, start, stop, score`` of every span; one row of nulls for a text without any."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    found = rows.select("row", "doc_id", F.flatten(F.array_compact(F.array(*[_proposals(F.col("text"), k) for k in KINDS]))).alias("found"))
    # one exchange by row serves the running sum and the later grouping
    each = found.select("row", "doc_id", F.explode_outer("found").alias("f")).select("row", "doc_id", "f.*").repartition("row")
    order = Window.partitionBy("row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.char_length("hit").cast("long")
    placed = each.withColumn("stop", F.sum(F.col("gap") + size).over(order)).withColumn("start", F.col("stop") - size)
    near = F.lower(F.concat_ws(" ", "before", "after"))
    context = F.when(F.col("kind").isNull(), False)
    for k, kind in enumerate(KINDS):
        context = context.when(F.col("kind") == k, near.rlike(CONTEXT[kind]))
    score = F.least(F.lit(1.0), _by_kind(PRIOR) + F.when(context, CONTEXT_GAIN).otherwise(0.0))
    checked = placed.select("row", "doc_id", "kind", "start", "stop", _valid().alias("valid"), score.alias("score"))
    report = F.col("valid") & ((F.col("kind") < BASE) | (F.col("score") >= LEAST_SCORE))
    names = ("kind", "start", "stop", "score")
    return checked.select("row", "doc_id", *[F.when(report, F.col(c)).alias(c) for c in names])


def scan(docs: DataFrame) -> DataFrame:
    """Per text: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_iban, n_ssn, highest_score``."""
    item = F.when(F.col("kind").isNotNull(), F.struct("start", "kind", "stop"))
    named = F.array(*[F.lit(k) for k in KINDS])

    def spelled(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.element_at(named, x["kind"] + 1), x["start"], x["stop"])), ",")

    each = spans(docs).groupBy("row", "doc_id").agg(
        *[F.sum(F.when(F.col("kind") == k, 1).otherwise(0)).alias(f"n_{KINDS[k]}") for k in range(len(KINDS))],
        F.array_sort(F.collect_list(item)).alias("found"), F.max("score").alias("highest_score"),
    )
    base = F.filter("found", lambda x: x["kind"] < BASE)
    return each.select(
        "doc_id", *[f"n_{k}" for k in KINDS[:BASE]], F.sha2(spelled(base), 256).alias("base_sha256"), spelled(F.col("found")).alias("spans"),
        *[f"n_{k}" for k in KINDS[BASE:]], "highest_score",
    )
