"""Text preparation as Column expressions.

Every function maps Column -> Column and stays inside the JVM, so a chain of
them compiles into one whole-stage-codegen projection. Order matters and
follows the cleaning recipe: lower -> punctuation -> digits -> tokens ->
shorthand -> (spelling, a job) -> stop words -> (lemmas, a job) -> join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.tables import WS_CLASS

# Python's ``[^\w\s]`` with Unicode semantics. Java's ``\w`` is ASCII-only, so
# the class is spelled out: letters, numbers, underscore, whitespace.
PUNCT_RE = r"[^\p{L}\p{N}_" + WS_CLASS + "]"
DIGITS_RE = r"\p{Nd}+"
# What T2 and T3 leave between spaces: letters, numbers but decimal digits, underscore.
WORD_RE = r"[\p{L}\p{Nl}\p{No}_]+"
WS_RUN_RE = "[" + WS_CLASS + "]+"

# Shorthand expansions applied to whole tokens.
SHORTHAND = {
    "acn": "can",
    "ya": "you",
    "pls": "please",
    "plz": "please",
    "u": "you",
    "ur": "your",
    "thx": "thanks",
    "tnx": "thanks",
    "im": "i am",
    "dont": "do not",
    "wanna": "want to",
    "gonna": "going to",
}

# Spark ML's default English stop-word list
# (StopWordsRemover.loadDefaultStopWords("english")), 181 words, in its order.
_LISTED_STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be been
being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before
after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now
i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm
you're he's she's it's we're they're i've we've you've they've isn't aren't
wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought
that's there's what's when's where's who's why's would
""".split())


def contraction_pieces(words) -> tuple[str, ...]:
    """What is left of the contractions of a list once punctuation is gone:
    their endings (``ll``, ``ve``, ``t``) and the stems of negations (``isn``)."""
    pieces = []
    for stem, mark, end in (w.partition("'") for w in words):
        if mark:
            pieces += [stem, end] if end == "t" else [end]
    return tuple(p for p in dict.fromkeys(pieces) if p not in words)


# Tokens reach the stop-word step without apostrophes, so the contractions of
# the list take effect through their pieces.
ENGLISH_STOP_WORDS = _LISTED_STOP_WORDS + contraction_pieces(_LISTED_STOP_WORDS)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c) -> Column:
    """Input coercion: cast to string; a missing value is empty text (Q1)."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def lower_text(c) -> Column:
    """T1."""
    return F.lower(as_text(c))


def strip_punctuation(c) -> Column:
    """Every non-word, non-space character becomes one space."""
    return F.regexp_replace(_col(c), PUNCT_RE, " ")


def strip_digits(c) -> Column:
    """Every run of decimal digits becomes one space."""
    return F.regexp_replace(_col(c), DIGITS_RE, " ")


def clean_basic(c) -> Column:
    """T1-T3 in order."""
    return strip_digits(strip_punctuation(lower_text(c)))


def tokenize(c) -> Column:
    """T4: split on whitespace runs, no empty tokens."""
    return F.filter(F.split(_col(c), WS_RUN_RE), lambda t: t != F.lit(""))


def expand_shorthand(tokens, mapping: dict | None = None,
                     split_expansions: bool = True) -> Column:
    """T5: exact-token expansion; unmapped tokens pass through.

    With ``split_expansions`` (default, Q3) a two-word value becomes two tokens.
    """
    mapping = mapping or SHORTHAND
    known = list(mapping)
    if not split_expansions:
        m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
        return F.transform(_col(tokens), lambda t: F.when(t.isin(known), F.try_element_at(m, t)).otherwise(t))
    # Only mapped tokens are looked up; ``isin`` becomes a hash set.
    m = F.create_map(*[x for k, v in mapping.items()
                       for x in (F.lit(k), F.array(*[F.lit(w) for w in v.split(" ")]))])
    return F.flatten(F.transform(_col(tokens), lambda t: F.when(
        t.isin(known), F.try_element_at(m, t)).otherwise(F.array(t))))


def is_stop_word(t: Column, stop_words=ENGLISH_STOP_WORDS) -> Column:
    # ``isin`` with a long literal list is rewritten by Catalyst to a hash set.
    return t.isin(list(stop_words))


def remove_stopwords(tokens, stop_words=ENGLISH_STOP_WORDS) -> Column:
    """Drop tokens that are exactly a stop word."""
    return F.filter(_col(tokens), lambda t: ~is_stop_word(t, stop_words))


def join_tokens(tokens) -> Column:
    """T9."""
    return F.array_join(_col(tokens), " ")


def token_count(clean) -> Column:
    """Whitespace token count of the cleaned text; 0 for empty text."""
    return F.size(F.filter(F.split(_col(clean), " "), lambda t: t != F.lit("")))


def basic_tokens(c, mapping: dict | None = None, split_expansions: bool = True) -> Column:
    """Raw text -> expanded token array. The tokens of T4 on a text
    after T1-T3, found in one pass over the lower-cased text."""
    tokens = F.regexp_extract_all(lower_text(c), F.lit(WORD_RE), F.lit(0))
    return expand_shorthand(tokens, mapping, split_expansions)


def clean_without_dictionary(c, stop_words=ENGLISH_STOP_WORDS) -> Column:
    """The cleaning recipe without the dictionary-backed steps."""
    return join_tokens(remove_stopwords(basic_tokens(c), stop_words))


def truncate_tokens(c, max_tokens: int = 256) -> Column:
    """The first ``max_tokens`` whitespace tokens (a model's input limit)."""
    return join_tokens(F.slice(tokenize(as_text(c)), 1, max_tokens))
