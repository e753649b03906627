"""Operator 12, personal data, with DataFrame functions only.

Detectors propose spans by regular expression.  A validator confirms each proposal from its own characters (Luhn,
mod-97, ranges, digit counts; what it refuses is dropped and not tried again), and gives it the detector's score; context words in the
``NEAR`` code points before or after the proposal add to it.  Spans that reach the threshold are kept.  The
four base detectors reach it alone; the others need a context word, or a checksum that leaves little to chance:

* ``card`` of 13 to 15 digits passing Luhn, near a word for cards;
* ``phone`` without country code, 8 to 15 digits, near a word for telephones;
* ``iban`` passing mod-97;
* ``ssn`` of three, two and four digits in the ranges that are issued, near a word for such numbers.

Proposals of one detector don't overlap; those of different ones may.  Patterns are possessive and anchored at the start of a run of their characters
(the leftmost match always starts there), so one pass over a text is linear in it, however long its runs of digits or letters.  Offsets
come from the lengths of the pieces between proposals, summed in blocks, so a text with very many spans costs little more than their number.
Every row is treated alone: nothing is shuffled.

Defined cases: a null text is empty; an empty text has no spans; repeated rows and null doc_ids count each; other columns are
ignored (:func:`find` carries those asked for); an empty table gives an empty result.  Digits and letters are ASCII ones.  Context ends at the next
proposal of the same detector.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import table

#: Code points before and after a proposal in which context words count.
NEAR = 40
THRESHOLD = 0.5
#: Values summed at once by :func:`running`.
BLOCK = 256

#: Kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")


def luhn(match: str) -> str:
    """The digits, every second one from the right doubled, sum to a multiple of ten."""
    return (f"aggregate(transform(filter(split(reverse(regexp_replace({match}, '[^0-9]', '')), ''), c -> c <> ''), (c, i) -> cast(c as int) * (1 + i % 2)), "
            "0, (a, v) -> a + v - if(v > 9, 9, 0)) % 10 = 0")


def mod_97(match: str) -> str:
    """First four characters moved to the end and letters read as 10 to 35, the number is 1 modulo 97."""
    plain = f"replace({match}, ' ', '')"
    return (f"aggregate(filter(split(concat(substring({plain}, 5), substring({plain}, 1, 4)), ''), c -> c <> ''), 0, "
            "(a, c) -> (a * if(c >= 'A', 100, 10) + ascii(c) - if(c >= 'A', 55, 48)) % 97) = 1")


def _octets(match: str) -> str:
    return f"forall(split({match}, '[.]'), p -> p rlike '^0*[0-9]{{1,3}}$' and cast(right(p, 3) as int) <= 255)"


def _digit_count(match: str) -> str:
    return f"length(regexp_replace({match}, '[^0-9]', '')) between 8 and 15"


def _issued(match: str) -> str:
    return f"not {match} rlike '^(000|666|9)|-00-|-0000$'"


@dataclass(frozen=True)
class Detector:
    kind: str
    #: Java regular expression of the proposals.
    pattern: str
    #: SQL of the condition on a match, whose SQL is given.
    confirms: Callable[[str], str]
    #: Of a confirmed proposal, and what a context word adds.
    score: float
    boost: float = 0.0
    #: Regular expression of the context words, over lower-cased text.
    context: str | None = None
    #: Text that every proposal holds; texts without it aren't searched.
    holds: str | None = None
    base: bool = False


_CARD_WORDS = r"\b(card|karte|kreditkarte|carte|tarjeta|visa|amex|mastercard)\b"
_PHONE_WORDS = r"\b(tel|phone|telephone|call|mobile|cell|fax|telefon|handy|téléphone|portable|teléfono|móvil)\b"
_SSN_WORDS = r"\b(ssn|social security)\b"


def _run_of_digits(least: int, most: int) -> str:
    """Maximal runs of digits, single spaces or hyphens between them allowed, with so many digits."""
    return rf"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){{{least - 1},{most - 1}}}+(?![\x20-]?[0-9])"


DETECTORS = (
    Detector("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
             lambda m: "true", 0.9, holds="@", base=True),
    Detector("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _octets, 0.6, holds=".", base=True),
    Detector("card", _run_of_digits(16, 19), luhn, 0.8, 0.2, _CARD_WORDS, base=True),
    Detector("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _digit_count, 0.6, 0.3, _PHONE_WORDS, holds="+", base=True),
    Detector("card", _run_of_digits(13, 15), luhn, 0.3, 0.4, _CARD_WORDS),
    Detector("phone", r"(?<![0-9+])(?<![0-9+][\x20().-])(?<![0-9+][\x20().-]{2})(?<![A-Za-z])\(?[0-9][\x20().0-9-]*[0-9]",
             _digit_count, 0.2, 0.4, _PHONE_WORDS),
    Detector("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:(?:\x20[A-Z0-9]{4}){2,7}+(?:\x20[A-Z0-9]{1,3})?|[A-Z0-9]{11,30}+)(?![A-Za-z0-9])",
             mod_97, 0.8),
    Detector("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", _issued, 0.3, 0.4, _SSN_WORDS),
)


def running(lengths: str) -> tuple[str, Callable[[str], str]]:
    """SQL of the sums of a column of longs before each block of it, and, given the column of those, of its running sums.

    Blocks are summed apart and shifted by the blocks before, because growing an array by one element copies it.
    """
    block = f"slice({lengths}, b * {BLOCK} + 1, {BLOCK})"
    grow = "named_struct('at', a.at + x, 'out', concat(a.out, array({})))"
    none = "array_remove(array(0L), 0L)"
    starts = (f"aggregate(transform(sequence(0, cast((size({lengths}) - 1) div {BLOCK} as int)), b -> aggregate({block}, 0L, (a, x) -> a + x)), "
              f"named_struct('at', 0L, 'out', {none}), (a, x) -> {grow.format('a.at')}, a -> a.out)")
    return starts, lambda before: (f"flatten(transform({before}, (first, b) -> aggregate({block}, named_struct('at', first, 'out', {none}), "
                                   f"(a, x) -> {grow.format('a.at + x')}, a -> a.out)))")


class _Steps:
    """The expressions of one detector, each over the columns of those before: proposals, gaps between them, stops, spans."""

    def __init__(self, i: int, d: Detector):
        self.d, self.m, self.g, self.l, self.b, self.e = d, f"m{i}", f"g{i}", f"l{i}", f"b{i}", f"e{i}"

    def proposals(self, text: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(self.d.pattern), F.lit(0))
        return found if self.d.holds is None else F.when(text.contains(self.d.holds), found).otherwise(_none())

    def gaps(self, text: Column) -> Column:
        return F.when(F.size(self.m) > 0, F.split(text, self.d.pattern, -1)).otherwise(_none())

    def lengths(self) -> Column:
        return F.expr(f"transform({self.m}, (m, j) -> cast(length({self.g}[j]) + length(m) as bigint))")

    def before(self) -> Column:
        return F.expr(running(self.l)[0])

    def stops(self) -> Column:
        return F.expr(running(self.l)[1](self.b))

    def _context(self) -> str:
        if self.d.context is None:
            return "0.0D"
        near = f"lower(concat(right({self.g}[j], {NEAR}), ' ', left({self.g}[j + 1], {NEAR})))"
        return f"if({near} rlike r'{self.d.context}', {self.d.boost}D, 0.0D)"

    def spans(self, threshold: float) -> Column:
        every = (f"transform({self.m}, (m, j) -> named_struct('at', {KINDS.index(self.d.kind)}, 'start', {self.e}[j] - length(m), 'stop', {self.e}[j], "
                 f"'kind', '{self.d.kind}', 'text', m, 'score', {self.d.score}D + {self._context()}, 'base', {str(self.d.base).lower()}))")
        return F.expr(f"filter({every}, s -> s.score >= {threshold}D and {self.d.confirms('s.text')})")


def _none() -> Column:
    return F.array().cast("array<string>")


def find(docs: DataFrame, keep: list[str], detectors: tuple[Detector, ...] = DETECTORS, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns of ``docs`` and spans: array<struct<at, start, stop, kind, text, score, base>>.

    ``at`` is the kind's place in ``KINDS``; spans are in order of it, then of ``start``; offsets count code points, ``stop`` is exclusive.
    """
    rows = docs.select(F.struct(*keep).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    parts = [_Steps(i, d) for i, d in enumerate(detectors)]
    m, g, lengths = [p.m for p in parts], [p.g for p in parts], [p.l for p in parts]
    # A select each, so that no later one evaluates the regular expressions again.
    rows = rows.select("row", "text", *[p.proposals(F.col("text")).alias(p.m) for p in parts])
    rows = rows.select("row", *m, *[p.gaps(F.col("text")).alias(p.g) for p in parts])
    rows = rows.select("row", *m, *g, *[p.lengths().alias(p.l) for p in parts])
    rows = rows.select("row", *m, *g, *lengths, *[p.before().alias(p.b) for p in parts])
    rows = rows.select("row", *m, *g, *[p.stops().alias(p.e) for p in parts])
    found = F.sort_array(F.concat(*[p.spans(threshold) for p in parts]))
    # A generator of one row: conditions of callers on the spans stay above it, where otherwise they would be rewritten down to the text.
    return rows.select("row", F.explode_outer(F.array(found)).alias("spans")).select("row.*", "spans")


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def query(spark, sf_dir):
    found = find(table(spark, sf_dir, "documents"), ["doc_id"])
    found = found.select("doc_id", "spans", F.filter("spans", lambda s: s["base"]).alias("base"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint) n_{k}") for k in KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
