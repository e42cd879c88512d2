"""Text expressions: word tokens and stop words."""

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two or more letters, digits or underscores of any script. Plain \w is ASCII only.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Spark's own English list (StopWordsRemover), in its order.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his
    himself she her hers herself it its itself they them their theirs themselves what which
    who whom this that these those am is are was were be been being have has had having do
    does did doing a an the and but if or because as until while of at by for with about
    against between into through during before after above below to from up down in out on
    off over under again further then once here there when where why how all any both each
    few more most other some such no nor not only own same so than too very s t can will
    just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
    they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't
    wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
    shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
    what's when's where's who's why's would
    """.split()
)


def tokens(text: Column) -> Column:
    """Lower-cased word tokens of the whole text; a null text has none."""
    return F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0)
    )


def stop_tokens(stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> list[str]:
    """The tokens of the stop words: ``isn't`` comes out of a text as ``isn``."""
    found = (token for word in stop_words for token in re.findall(r"\w{2,}", word.lower()))
    return list(dict.fromkeys(found))


def without_stop_words(
    words: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS
) -> Column:
    """Drop the tokens of stop words; order and repeats of the other words are kept.

    ``isin`` with a long list compiles to a hash-set probe, so the cost per word does not
    depend on the list.
    """
    stop = stop_tokens(stop_words)
    return F.filter(words, lambda word: ~word.isin(stop)) if stop else words
