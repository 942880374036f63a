"""Lemmas of words that no table lists, from the endings of those it does.

A rule says that words with some ending lose their last ``cut`` characters and gain ``add``. Every (token, lemma) pair speaks
for its own change under all its endings up to ``context`` characters longer than what is cut; an ending keeps the change
most pairs speak for. A word takes the rule of its longest ending that has one.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.checks import require_columns, require_positive
from tagloom.operators.lexicon import MAX_LEXICON_ROWS, lemmatize, tokens
from tagloom.operators.sizing import small_or_whole, small_rows, staged

CONTEXT = 4
MIN_SUPPORT = 3

_COMMON = "size(filter(sequence(1, least(length(token), length(lemma))), i -> left(token, i) = left(lemma, i)))"


def learn_rules(lexicon: DataFrame, *, context: int = CONTEXT, min_support: int = MIN_SUPPORT, min_share: float = 0.5) -> DataFrame:
    """``suffix``, ``cut``, ``add``, ``n`` pairs that speak for the rule and ``total`` pairs with that ending.

    Kept are rules with ``min_support`` pairs that make up ``min_share`` of their ending. Ties go to the smaller cut, then to
    the smaller addition. Pairs with a null or empty side are left out.
    """
    require_positive(context=context, min_support=min_support)
    require_columns(lexicon, ["token", "lemma"], "lexicon")
    pairs = lexicon.select("token", "lemma").filter("length(token) > 0 AND length(lemma) > 0")
    pairs = pairs.withColumn("common", F.expr(_COMMON))
    changes = pairs.select("token", F.expr("length(token) - common").alias("cut"), F.expr("substr(lemma, common + 1)").alias("add"))
    sizes = F.expr(f"explode(sequence(greatest(cut, 1), least(length(token), cut + {int(context)})))")
    endings = changes.select("token", "cut", "add", sizes.alias("size")).select(F.expr("right(token, size)").alias("suffix"), "cut", "add")
    counts = endings.groupBy("suffix", "cut", "add").agg(F.count(F.lit(1)).alias("n"))
    of_ending = Window.partitionBy("suffix")
    ranked = counts.withColumn("total", F.sum("n").over(of_ending)).withColumn(
        "_place", F.row_number().over(of_ending.orderBy(F.col("n").desc(), "cut", "add"))
    )
    kept = ranked.filter((F.col("_place") == 1) & (F.col("n") >= min_support) & (F.col("n") >= min_share * F.col("total")))
    return kept.drop("_place")


def guess_lemmas(words: DataFrame, rules: DataFrame) -> DataFrame:
    """``token`` and ``lemma`` of every distinct token whose endings have a rule that leaves something of it."""
    require_columns(words, ["token"], "words")
    known = small_or_whole(rules.select("suffix", "cut", "add"))
    longest = rules.agg(F.max(F.length("suffix"))).first()[0] or 0
    distinct = words.select("token").filter("length(token) > 0").distinct()
    if not longest:
        return distinct.limit(0).withColumn("lemma", F.col("token"))
    sizes = F.expr(f"explode(sequence(1, least(length(token), {longest})))")
    endings = distinct.select("token", sizes.alias("size")).withColumn("suffix", F.expr("right(token, size)"))
    best = endings.join(known, "suffix").groupBy("token").agg(F.max_by(F.struct("cut", "add"), "size").alias("rule"))
    lemma = F.expr("concat(left(token, length(token) - rule.cut), rule.add)")
    return best.select("token", lemma.alias("lemma")).filter("lemma <> ''")


def guesser(rules: pa.Table) -> Callable[[str], str | None]:
    """A function from a word to what the rule of its longest ending makes of it, as ``guess_lemmas`` does."""
    change = {r["suffix"]: (r["cut"], r["add"]) for r in rules.to_pylist() if None not in r.values()}
    longest = max(map(len, change), default=0)

    def guess(word: str) -> str | None:
        for size in range(min(len(word), longest), 0, -1):
            rule = change.get(word[-size:])
            if rule is not None:
                return word[: max(0, len(word) - rule[0])] + rule[1] or None
        return None

    return guess


def lemmatize_all(
    rows: DataFrame,
    lexicon: DataFrame,
    *,
    key: str,
    text: str = "text",
    out: str = "lemmas",
    rules: DataFrame | None = None,
    max_lexicon_rows: int = MAX_LEXICON_ROWS,
) -> DataFrame:
    """Lemmas of each text where words outside the lexicon go by ``rules``, learned from it unless given.

    Words the lexicon has no lemma for, and words without a rule, are left out. A lexicon and rules of bounded size travel
    with the tasks, which guess where the text lies; else guesses are made once per distinct word and joined.
    """
    require_columns(rows, [key, text], "texts")
    require_columns(lexicon, ["token", "lemma"], "lexicon")
    lexicon = staged(lexicon.select("token", "lemma"), "lexicon")
    rules = staged(learn_rules(lexicon) if rules is None else rules, "rules")
    options = dict(key=key, text=text, out=out, max_lexicon_rows=max_lexicon_rows)
    few = small_rows(rules.select("suffix", "cut", "add"))
    if few is not None and small_rows(lexicon, max_lexicon_rows) is not None:
        return lemmatize(rows, lexicon, guess=guesser(few), **options)
    words = rows.select(F.explode(tokens(F.col(text))).alias("token")).distinct()
    unseen = words.join(small_or_whole(lexicon.select("token"), max_lexicon_rows), "token", "left_anti")
    whole = lexicon.unionByName(guess_lemmas(unseen, rules))
    return lemmatize(rows, staged(whole, "lemmas"), **options)


def held_out_share(lexicon: DataFrame, *, folds: int = 5, **options) -> DataFrame:
    """Learn from most pairs and guess the others: ``pairs`` held out, how many got a guess, how many the right one."""
    require_positive(folds=folds)
    late = F.crc32(F.col("token").cast("binary")) % folds == 0
    held_out = lexicon.filter(late).filter("length(token) > 0 AND length(lemma) > 0")
    guesses = guess_lemmas(held_out, staged(learn_rules(lexicon.filter(~late), **options), "rules")).withColumnRenamed("lemma", "guess")
    return held_out.join(guesses, "token", "left").agg(
        F.count(F.lit(1)).alias("pairs"), F.count("guess").alias("guessed"), F.count_if(F.col("guess") == F.col("lemma")).alias("right")
    )
