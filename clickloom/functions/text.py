"""String cleaning and tokens."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TOKEN = r"[\p{L}\p{N}_]{2,}"

# The English list of Spark's StopWordsRemover, in its order.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()


# The characters that count as whitespace in Unicode text.
WHITESPACE = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Remove whitespace of every kind from both ends (``trim`` removes spaces only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def text_or(c: Column, default: str = "") -> Column:
    return F.coalesce(c, F.lit(default))


def blank_to_null(c: Column, stripper=F.trim) -> Column:
    return F.nullif(stripper(c), F.lit(""))


def tokens(c: Column) -> Column:
    """Lower-case word tokens of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0))


def joined_text(title: Column, *bodies: Column) -> Column:
    """Title followed by the first body that is not blank."""
    body = F.coalesce(*[blank_to_null(b, strip) for b in bodies], F.lit(""))
    return strip(F.concat_ws(" ", text_or(strip(title)), body))
