"""Lines of text to VARIANT records, with the malformed ones marked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.session import prepare

OK = "ok"
MALFORMED = "malformed"
NOT_OBJECT = "not_object"
NO_ID = "no_id"
STRICT = "strict:"

FRAME = "framed"
RECORD = "$[0]"  # where the record sits inside the frame

_PROOF = "$[1]"
_REST = "$[2]"
_JSON_BLANKS = " \t\r\n"


def parse_lines(lines: DataFrame, value: str = "value", keep_lines: bool = False) -> DataFrame:
    """Add ``status`` and the parsed line ``framed``; ``raw`` keeps the text of bad lines.

    The parser stops at the end of the first JSON value and would accept trailing junk. So
    each line is parsed once as the first element of a list whose second and last element is
    the hash of the line: junk either breaks the list or displaces the hash. The record is
    read in place, at ``RECORD`` inside the frame, because taking it out would rebuild it.
    Columns starting with an underscore (origin of the line) are carried along, and with
    ``keep_lines`` every line as ``line``. Of a repeated key the later value counts, for which the
    session gets its setting here (`prepare`).
    """
    prepare(lines.sparkSession)
    line = F.col(value)
    framed = F.concat(
        F.lit("["), line, F.lit(","), F.xxhash64(line).cast("string"), F.lit("]")
    )
    origin = [c for c in lines.columns if c.startswith("_")]
    # The one-element explode keeps the optimizer from copying the parse into every filter
    # and projection that uses its result.
    parsed = lines.select(
        *origin, line.alias("line"), F.explode_outer(F.array(F.try_parse_json(framed))).alias(FRAME)
    )
    proved = F.try_variant_get(FRAME, _PROOF, "bigint") == F.xxhash64("line")
    whole = F.coalesce(proved, F.lit(False)) & F.try_variant_get(FRAME, _REST, "variant").isNull()
    is_object = F.ltrim("line", F.lit(_JSON_BLANKS)).startswith("{")
    status = F.when(~whole, MALFORMED).when(~is_object, NOT_OBJECT).otherwise(OK)
    return parsed.select(*origin, status.alias("status"), "line", FRAME).select(
        *origin, *(["line"] if keep_lines else []), "status", F.when(F.col("status") != OK, F.col("line")).alias("raw"), FRAME
    )


def record() -> Column:
    """The record of a well-formed line as a VARIANT of its own."""
    return F.when(
        F.col("status") != MALFORMED, F.try_variant_get(FRAME, RECORD, "variant")
    )


def records(parsed: DataFrame, name: str = "v", text: str | None = None) -> DataFrame:
    """The good lines, with their records as VARIANT column ``name``; ``text`` names their lines.

    To have the lines, parse with ``keep_lines``.
    """
    origin = [c for c in parsed.columns if c.startswith("_")]
    lines = [F.col("line").alias(text)] if text else []
    return parsed.where(F.col("status") == OK).select(*origin, *lines, record().alias(name))
