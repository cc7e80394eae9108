"""Tokens, and the inverted index form in which abstracts are stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a search token is a run of letters and digits of any script in the lower-cased text.
TOKEN = r"[\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def placed_tokens(text: Column) -> Column:
    """The tokens of a text, each with its place from 0."""
    return F.transform(tokens(text), lambda t, i: F.struct(t.alias("token"), i.alias("at")))


def invert(rows: DataFrame, placed: str, keep: Sequence[str]) -> DataFrame:
    """(*keep, words): each row's tokens, once each and in order, with their positions.

    ``placed`` holds a row's tokens as `placed_tokens` gives them. They are grouped without a shuffle:
    sorted by token, each token's positions are a slice.
    """
    # the one-element explodes keep what follows from cutting and sorting the text again
    cut = rows.select(*keep, F.explode(F.array(F.sort_array(placed))).alias("_all"))
    cut = cut.select(*keep, F.transform("_all", lambda x: x["token"]).alias("_tokens"), F.transform("_all", lambda x: x["at"]).alias("_at"))
    first = F.filter(
        F.transform("_tokens", lambda t, i: F.when((i == 0) | (F.get("_tokens", i - 1) != t), i)), lambda i: i.isNotNull()
    )
    cut = cut.select(*keep, "_tokens", "_at", F.explode(F.array(first)).alias("_first"))

    def word(a: Column, n: Column) -> Column:
        b = F.coalesce(F.get("_first", n + 1), F.size("_at"))
        return F.struct(F.get("_tokens", a).alias("token"), F.slice("_at", a + 1, b - a).alias("positions"))

    # words of their own row: exploding them from here copies no text for each of them
    return cut.select(*keep, F.explode(F.array(F.transform("_first", word))).alias("words"))


def rebuild_text(inverted: Column) -> Column:
    """Words of a {word: [positions]} map, put back in position order."""
    placed = F.flatten(
        F.transform(
            F.map_entries(inverted),
            lambda e: F.transform(
                e["value"], lambda p: F.struct(p.alias("at"), e["key"].alias("word"))
            ),
        )
    )
    return F.array_join(F.transform(F.sort_array(placed), lambda w: w["word"]), " ")


def positions_of(inverted: Column, word: str) -> Column:
    return F.try_element_at(inverted, F.lit(word))
