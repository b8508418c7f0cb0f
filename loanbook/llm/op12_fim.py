"""Fill-in-the-middle: texts cut at two units and put in another order.

A unit is a run of ASCII letters or any other single code point. One full match of
`(unit)*` keeps every repetition of the group, so the ends of its captures give the
number of units and both cuts at once. Longer texts than `WINDOW` are matched
in windows that end between units, so that captures stay in bounded memory. Python
returns three numbers a row; the JVM takes the text apart and puts it together.

Nothing is shuffled. A null text counts as empty, a null id as empty text; repeated
rows give equal rows. Columns other than `doc_id` and `text` are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanbook.llm.common import small_batches

#: Code points that are matched at once.
WINDOW = 1 << 20

UNITS = regex.compile("([A-Za-z]+|[^A-Za-z])*")
_LETTER_END = regex.compile("[^A-Za-z]")

# Marks of the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

_CUTS = pa.struct([("n", pa.int64()), ("first", pa.int64()), ("second", pa.int64())])


def _windows(text: str) -> Iterator[tuple[int, int]]:
    """Spans of about `WINDOW` code points that end between units; one at least."""
    at = 0
    while len(text) - at > WINDOW:
        # A code point that is no letter ends a unit.
        end = _LETTER_END.search(text, at + WINDOW)
        if end is None:
            break
        yield at, end.end()
        at = end.end()
    yield at, len(text)


def cuts(text: str, first: int, second: int) -> tuple[int, int, int]:
    """Number n of units, and where the two cuts are in code points.

    The cuts are after `first % (n + 1)` and `second % (n + 1)` units, the smaller first.
    """
    spans, counts, ends = list(_windows(text)), [], []
    for span in spans:
        ends = UNITS.fullmatch(text, *span).ends(1)
        counts.append(len(ends))
    n = sum(counts)

    def place(units: int) -> int:
        if not units:
            return 0
        for span, count in zip(spans, counts):
            if units <= count:
                own = ends if len(spans) == 1 else UNITS.fullmatch(text, *span).ends(1)
                return own[units - 1]
            units -= count
        raise AssertionError("more units than the text has")

    low, high = sorted((first % (n + 1), second % (n + 1)))
    return n, place(low), place(high)


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in _CUTS.names]))
def _cuts(texts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for batch in texts:
        found = [cuts(*row) for row in zip(*(part.to_pylist() for part in batch))]
        yield pa.array([dict(zip(_CUTS.names, row)) for row in found], type=_CUTS)


def _drawn(group: int) -> Column:
    """One of the eight groups of hex digits of the document's digest, as a number."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit("1:"), doc_id).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * group - 7, 8), 16, 10).cast("long")


def fill_in_middle(documents: DataFrame, rate: int = 90, spm_rate: int = 20) -> DataFrame:
    """Every text in its order: `(doc_id, n, form, prefix_chars, middle_chars, output)`.

    `rate` of a hundred texts are cut, `spm_rate` of these with the suffix
    first. Empty texts and those that hold a mark stay plain: `output` is the text, and
    the numbers of characters are null. What is drawn depends on the id only.
    """
    small_batches(documents.sparkSession)
    text = F.col("text")
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (text == "") | marked | (_drawn(3) % 100 >= rate)
    form = F.when(plain, PLAIN).when(_drawn(4) % 100 < spm_rate, SPM).otherwise(PSM)
    cut = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns(
        {"cut": _cuts("text", _drawn(1), _drawn(2)), "form": form}
    )
    first, second = F.col("cut.first").cast("int"), F.col("cut.second").cast("int")
    prefix, middle = F.substr(text, F.lit(1), first), F.substr(text, first + 1, second - first)
    suffix = F.substr(text, second + 1)
    output = (
        F.when(F.col("form") == PLAIN, text)
        .when(F.col("form") == PSM, F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    was_cut = F.col("form") != PLAIN
    return cut.select(
        "doc_id",
        F.col("cut.n").alias("n"),
        "form",
        F.when(was_cut, F.col("cut.first")).alias("prefix_chars"),
        F.when(was_cut, F.col("cut.second") - F.col("cut.first")).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that `output` was made of.

    Its parts hold no marks and marks do not overlap, so the first mark of each kind is its own.
    """
    marks = {kind: f"{a}|{MIDDLE}" for kind, a in ((PSM, SUFFIX), (SPM, PREFIX))}
    inner = F.substr(output, F.lit(len(PREFIX) + 1))
    psm, spm = F.split(inner, marks[PSM], -1), F.split(inner, marks[SPM], -1)
    return (
        F.when(form == PLAIN, output)
        .when(form == PSM, F.concat(psm[0], psm[2], psm[1]))
        .otherwise(F.concat(spm[1], spm[2], spm[0]))
    )
