"""Personal data in text, by patterns, checksums and context words.

Column expressions only. Regular expressions propose spans, validators (Luhn,
mod 97, octets, digit counts) confirm them, and words close to a span raise or
lower its score. Base kinds stay whatever their score; added kinds go below
KEEP_SCORE, so an IBAN beside words of an example is none, and a long hexadecimal
number is a key only beside words that say so.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone", "iban", "key")
BASE = KINDS[:4]
CONTEXT_CHARS = 40
KEEP_SCORE = 0.5

# The base patterns. A guard stands before each: a match starts
# where a run starts or where the last match ended, which changes no match and
# keeps long runs linear; possessive loops for the same reason.
_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "key": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}(?![A-Za-z0-9])|(?:password|token|secret|api_key)\x20?[=:]\x20?[\x22']?[0-9A-Za-z_-]{8,64}|(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})(?![A-Za-z0-9]))",
}
_SURE_KEY = r"^(?:AKIA|password|token|secret|api_key)"
_OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
# Cheap tests that a text holds anything worth a pattern.
_HINTS = {
    "email": r"@[A-Za-z0-9-]+\.",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){15}",
    "phone": r"\+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]",
    "key": r"AKIA|[=:]\x20?[\x22']?[0-9A-Za-z_-]{8}|[0-9a-f]{32}",
}
_PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.65, "key": 0.45}
_SURE = 0.35  # more for a key that names itself
_RAISE = r"(?i)\b(?:mail|contact|card|visa|pay|phone|call|tel|mobile|account|bank|iban|address|host|server|login|user|password|key|token)\b"
_LOWER = r"(?i)\b(?:fake|placeholder|checksum|digest|commit|version|release|example|sample|dummy|section|build|order|isbn|total)\b"


@dataclass(frozen=True)
class Mask:
    """How a redacted span reads."""

    open: str = "<"
    close: str = ">"

    def of(self, kind: str) -> str:
        return f"{self.open}{kind.upper()}{self.close}"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn's checksum of at most 19 digits."""
    n = F.length(digits)
    place = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.when(
            (n - i) % 2 == 1, F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substr(digits, i, F.lit(1)).cast("int") + 1)
        ).otherwise(F.substr(digits, i, F.lit(1)).cast("int")),
    )
    return F.aggregate(place, F.lit(0), lambda a, x: a + x) % 10 == 0


def _mod97(iban: Column) -> Column:
    """ISO 13616: the first four characters move to the end, letters become
    numbers from 10, and the remainder by 97 is 1."""
    flat = F.regexp_replace(iban, " ", "")
    turned = F.concat(F.substr(flat, F.lit(5)), F.substr(flat, F.lit(1), F.lit(4)))

    def step(a: Column, ch: Column) -> Column:
        code = F.ascii(ch)
        return F.when(code >= 65, (a * 100 + code - 55) % 97).otherwise((a * 10 + code - 48) % 97)

    return F.aggregate(F.split(turned, "(?!^)(?=.)"), F.lit(0), step) == 1


def _valid(kind: str, match: Column) -> Column:
    digits = _digits(match)
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        # the length test stands inside: a long run of digits is not summed
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "iban":
        return F.when(F.length(F.regexp_replace(match, " ", "")).between(15, 34), _mod97(match)).otherwise(False)
    return F.lit(True)


def _score(kind: str, match: Column, before: Column, after: Column) -> Column:
    """Prior of the kind, moved by context words in the characters on both sides."""
    near = lambda words: before.rlike(words) | after.rlike(words)
    raised = F.when(near(_RAISE), 0.1).otherwise(0.0)
    lowered = F.when(near(_LOWER), 0.2).otherwise(0.0)
    prior = F.lit(_PRIOR[kind])
    if kind == "key":
        prior = prior + F.when(match.rlike(_SURE_KEY), _SURE).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), prior + raised - lowered))


_SPAN = "struct<kind:string,start:int,end:int,score:double>"


def _spans_of(kind: str, text: Column) -> Column:
    """Valid spans of one kind in a text, by start, in code points.

    The parts between matches and the matches themselves come from two passes
    over the text; positions are their lengths added up.
    """
    pattern = F.lit(_PATTERNS[kind])
    between = F.split(text, _PATTERNS[kind], -1)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    # each match with what is before and after it, up to its neighbours
    pairs = F.transform(
        matches,
        lambda m, i: F.struct(m.alias("m"), F.get(between, i).alias("b"), F.left(F.get(between, i + 1), F.lit(CONTEXT_CHARS)).alias("after")),
    )

    def step(a: Column, p: Column) -> Column:
        start = a["at"] + F.length(p["b"])
        end = start + F.length(p["m"])
        score = _score(kind, p["m"], F.right(p["b"], F.lit(CONTEXT_CHARS)), p["after"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), score.alias("score"))
        keep = _valid(kind, p["m"])
        if kind not in BASE:
            keep = keep & (score >= KEEP_SCORE)
        return F.struct(
            end.alias("at"),
            F.when(keep, F.concat(a["spans"], F.array(span))).otherwise(a["spans"]).alias("spans"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))
    found = F.aggregate(pairs, start, step, lambda a: a["spans"])
    return F.when(text.rlike(_HINTS[kind]), found).otherwise(F.array().cast(f"array<{_SPAN}>"))


def spans(text: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """All valid spans of a text: kind as listed, then start; an array of
    kind, start, end (exclusive, code points) and score. Null counts as empty.

    Base kinds are leftmost and do not overlap within their kind; those that pass
    their check all stay. Added kinds also need a score of KEEP_SCORE. Spans of
    different kinds may overlap.
    """
    whole = F.coalesce(text, F.lit(""))
    return F.concat(*[_spans_of(k, whole) for k in kinds])


def find(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """`docs` with the spans of each text. Null and empty texts have none; rows,
    repeats and other columns stay as they are; a column named `out` is replaced."""
    return docs.withColumn(out, spans(F.col(text)))


def redact(docs: DataFrame, text: str = "text", mask: Mask = Mask()) -> DataFrame:
    """`docs` with every span that `find` gives replaced by its kind's mask.

    Of spans that overlap, the first stays, the longer one if they start
    together; what it covers is masked once. A null text stays null.
    """
    found = spans(F.col(text))
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(s["start"], (-s["end"]).alias("back"), s["kind"])))
    whole = F.col(text)
    label = F.create_map(*[F.lit(v) for k in KINDS for v in (k, mask.of(k))])

    def step(a: Column, s: Column) -> Column:
        end = -s["back"]
        new = s["start"] >= a["at"]
        gap = F.substr(whole, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
        return F.struct(
            F.greatest(a["at"], end).alias("at"),
            F.when(new, F.concat(a["done"], F.array(gap, label[s["kind"]]))).otherwise(a["done"]).alias("done"),
        )

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("done"))
    rest = F.aggregate(
        ordered, zero, step, lambda a: F.concat(F.array_join(a["done"], ""), F.substr(whole, a["at"] + 1))
    )
    return docs.withColumn(text, F.when(F.size(found) > 0, rest).otherwise(whole))
