"""Lemmatising and entity extraction against tables of known forms.

Lemmas come from a (token, lemma) table and entities from a table of names; both are inputs. A table of
bounded size travels with the task code and texts never move. A larger one is joined with the exploded
tokens, whose frequent values skew handling splits.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.checks import require_columns
from tagloom.operators.sizing import lookup_join, small_rows

MAX_LEXICON_ROWS = 500_000

# Fixed value: a token is a run of letters, digits or underscores.
TOKEN = r"[\p{L}\p{N}_]+"


def tokens(c: Column) -> Column:
    """Lower-cased word tokens in order."""
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0))


def lemmatize(
    rows: DataFrame,
    lexicon: DataFrame,
    *,
    key: str,
    text: str = "text",
    out: str = "lemmas",
    max_lexicon_rows: int = MAX_LEXICON_ROWS,
    guess: Callable[[str], str | None] | None = None,
) -> DataFrame:
    """Lemmas of each text joined by one space, in order; tokens without a lemma are left out.

    ``guess`` gives the lemma of a token that the lexicon does not list; it needs a lexicon of bounded size.
    """
    require_columns(rows, [key, text], "texts")
    require_columns(lexicon, ["token", "lemma"], "lexicon")
    known = small_rows(lexicon.select("token", "lemma"), max_lexicon_rows)
    words = F.coalesce(tokens(F.col(text)), F.array().cast("array<string>"))
    if known is not None:
        if pc.count_distinct(known["token"], mode="all").as_py() != known.num_rows:
            raise ValueError("lexicon holds more than one row for some token")
        forms, lemma_of = (known[c].cast(pa.string()).combine_chunks() for c in ("token", "lemma"))

        @F.arrow_udf("string")
        def lemmas(batch: pa.Array) -> pa.Array:
            split = pc.split_pattern(batch.cast(pa.string()), " ")
            flat = split.flatten().dictionary_encode()  # each different word is looked up once
            place = pc.index_in(flat.dictionary, value_set=forms)
            lemma = lemma_of.take(place)
            if guess is not None:
                guessed = [guess(word) for word in flat.dictionary.filter(place.is_null()).to_pylist()]
                lemma = pc.replace_with_mask(lemma, place.is_null(), pa.array(guessed, pa.string()))
            told = lemma.take(flat.indices)
            told = pc.if_else(pc.greater(pc.utf8_length(told), 0), told, None)
            found = told.is_valid().to_numpy(zero_copy_only=False)
            ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
            kept = np.concatenate([[0], np.cumsum(found)])
            offsets = np.concatenate([[0], kept[ends]]).astype(np.int32)
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), told.drop_null()), " ")

        return rows.withColumn(out, lemmas(F.array_join(words, " ")))
    if guess is not None:
        raise ValueError(f"a lexicon of more than {max_lexicon_rows} rows takes no guesses")
    exploded = rows.select(key, F.posexplode(words).alias("_pos", "token"))
    found = lookup_join(exploded, lexicon.select("token", "lemma"), "token", "inner", "lexicon", max_lexicon_rows)
    found = found.filter(F.length("lemma") > 0)
    joined = found.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_pos", "lemma"))).alias("_found"))
    lemma_text = F.array_join(F.col("_found.lemma"), " ")
    return rows.join(joined, key, "left").withColumn(out, F.coalesce(lemma_text, F.lit(""))).drop("_found")


def extract_entities(
    rows: DataFrame,
    gazetteer: DataFrame,
    *,
    key: str,
    text: str = "text",
    name: str = "name",
    max_words: int | None = None,
    out: str = "entities",
    max_gazetteer_rows: int = MAX_LEXICON_ROWS,
) -> DataFrame:
    """Known names in each text in order of appearance, duplicates kept, an empty list for none.

    Names compare by their tokens. Where several begin at one token the longest counts, and a name that
    overlaps the one before it does not count. ``max_words`` leaves out longer names; by default there are none.
    """
    require_columns(rows, [key, text], "texts")
    require_columns(gazetteer, [name], "gazetteer")
    names = gazetteer.select(F.array_join(tokens(F.col(name)), " ").alias("_form"), F.col(name).alias("_name"))
    names = names.filter(F.col("_form") != "").groupBy("_form").agg(F.min("_name").alias("_name"))
    if max_words is not None:
        names = names.filter(F.size(F.split("_form", " ")) <= max_words)
    words = F.coalesce(tokens(F.col(text)), F.array().cast("array<string>"))
    known = small_rows(names, max_gazetteer_rows)
    if known is not None:
        name_of = dict(zip(known["_form"].to_pylist(), known["_name"].to_pylist()))
        longest = {}
        for form in name_of:
            first, size = form.split(" ", 1)[0], form.count(" ") + 1
            longest[first] = max(size, longest.get(first, 0))
        starts = pa.array(list(longest), pa.string())

        @F.arrow_udf("array<string>")
        def spans(batch: pa.Array) -> pa.Array:
            split = pc.split_pattern(batch.cast(pa.string()), " ")
            flat = split.flatten()
            ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
            places = np.flatnonzero(pc.is_in(flat, value_set=starts).to_numpy(zero_copy_only=False))
            row_of = np.searchsorted(ends, places, side="right")
            hits, rows, after = [], [], 0
            for at, row in zip(places.tolist(), row_of.tolist(), strict=True):  # only where some name may begin
                if at < after:
                    continue
                stop = min(int(ends[row]), at + longest[flat[at].as_py()])
                window = flat.slice(at, stop - at).to_pylist()
                for size in range(len(window), 0, -1):
                    hit = name_of.get(" ".join(window[:size]))
                    if hit is not None:
                        hits.append(hit)
                        rows.append(row)
                        after = at + size
                        break
            offsets = np.searchsorted(np.array(rows, np.int64), np.arange(len(batch) + 1)).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(hits, pa.string()))

        return rows.withColumn(out, spans(F.array_join(words, " ")))

    most = names.agg(F.max(F.size(F.split("_form", " ")))).first()[0] or 1

    def grams_at(pos: Column) -> Column:
        sizes = F.sequence(F.lit(1), F.least(F.lit(most), F.size("_w") - pos))
        form = lambda size: F.array_join(F.slice("_w", pos + 1, size), " ")
        return F.transform(sizes, lambda size: F.struct(pos.alias("_pos"), size.alias("_size"), form(size).alias("_form")))

    listed = rows.select(key, words.alias("_w")).filter(F.size("_w") > 0)
    starts = F.sequence(F.lit(0), F.size("_w") - 1)
    grams = listed.select(key, F.inline(F.flatten(F.transform(starts, grams_at))))
    hits = lookup_join(grams, names, "_form", "inner", "gazetteer", max_gazetteer_rows)
    longest = hits.groupBy(key, "_pos").agg(F.max(F.struct("_size", "_name")).alias("_hit"))
    ordered = longest.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_pos", "_hit"))).alias("_hits"))
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("names"))

    def take(acc, hit):
        after = F.struct(
            (hit["_pos"] + hit["_hit"]["_size"]).alias("end"),
            F.concat(acc["names"], F.array(hit["_hit"]["_name"])).alias("names"),
        )
        return F.when(hit["_pos"] >= acc["end"], after).otherwise(acc)

    kept = ordered.select(key, F.aggregate("_hits", start, take)["names"].alias(out))
    return rows.join(kept, key, "left").withColumn(out, F.coalesce(out, F.array().cast("array<string>")))
