"""Text expressions: all built from JVM functions, so that they stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that wrap a name without changing its identity (fixed values).
SUFFIX_WORDS = (
    "scanner system device machine platform instrument apparatus unit analyzer analyser reader database registry repository dataset data "
    "service services core facility laboratory lab bibliographic statistical computing environment software"
).split()
#: Words that title keys leave out (fixed values).
TITLE_STOP = "a an and for in of on the to with research award awards grant grants program fellowship foundation fund".split()
#: Verbs of use, and phrases of background mentions (fixed values).
USE_VERBS = (
    "expressed expressing transfected transfection transduced transduction cultured culturing treated incubated stained immunostained overexpressed "
    "knockdown knocked silenced seeded plated infected electroporated injected differentiated cotransfected transformed grown maintained passaged "
    "engineered immortalized lysed harvested exposed administered perfused"
).split()
BACKGROUND = (
    "widely used", "commonly used", "routinely used", "frequently used", "are used", "is used", "well established", "well-established", "gold standard",
    "is a popular", "are a popular", "good manufacturing practice", "is a model", "are a model", "model system", "is a common", "are common",
    "is one of the most", "are one of the most", "is a widely", "are widely",
)


#: Before and after a run of ASCII word signs. Java's own \b also counts other letters as word signs, and not in every version.
START, END = r"(?<!\w)", r"(?!\w)"


def plain_lower(c: Column) -> Column:
    """Lower case sign by sign: as many signs as before, and no final sigma."""
    return F.lower(F.translate(c, "İΣ", "iσ"))


def round_four(c: Column) -> Column:
    """A double times 10,000 to the next whole number, halves up, and back: its binary value decides a tie, not its decimals."""
    return F.round(c * 10_000) / 10_000


def norm_name(c: Column) -> Column:
    """Lower case, runs of other signs to one blank, trimmed."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def norm_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def strip_suffix(c: Column) -> Column:
    """Drops a trailing run of wrapping words, the first word stays."""
    return F.regexp_replace(c, f"^(\\S+(?: \\S+)*?)(?: (?:{'|'.join(SUFFIX_WORDS)}))+$", "$1")


def surface_keys(c: Column) -> Column:
    """Sorted keys under which a name is known: itself, without parentheses, short forms in them, without wrapping words."""
    bare = norm_name(F.regexp_replace(c, r"\([^)]*\)", " "))
    whole = norm_name(c)
    inner = F.filter(F.transform(F.regexp_extract_all(c, F.lit(r"\(([^)]*)\)"), 1), lambda x: F.trim(x)), lambda x: ~x.contains(" ") & F.length(x).between(2, 15))
    shorter = lambda k: F.when((strip_suffix(k) != k) & (F.length(strip_suffix(k)) >= 3), strip_suffix(k))
    keys = F.concat(F.transform(inner, norm_name), F.array(whole, bare, shorter(whole), shorter(bare)))
    return F.array_sort(F.array_distinct(F.filter(keys, lambda k: k.isNotNull() & (k != ""))))


def title_tokens(c: Column) -> Column:
    """Sorted distinct words without the words that title keys leave out."""
    return F.array_sort(F.array_except(F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), 0), F.array(*[F.lit(w) for w in TITLE_STOP])))


def strip_html(c: Column) -> Column:
    """Tags to blanks, the common entities decoded, white space single."""
    bare = F.regexp_replace(c, "<[^>]+>", " ")
    for name, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(name), F.lit(sign))
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def sentence_case(c: Column) -> Column:
    """First letter up, later words of capital and small letters down; acronyms stay."""
    words = F.split(F.trim(F.regexp_replace(c, r"\s+", " ")), " ")
    later = F.transform(F.slice(words, 2, 10_000), lambda w: F.when(w.rlike("^[A-Z][a-z]+$"), F.lower(w)).otherwise(w))
    first = F.element_at(words, 1)
    return F.array_join(F.concat(F.array(F.concat(F.upper(F.substring(first, 1, 1)), F.substring(first, 2, 1000))), later), " ")


def fit_words(c: Column, width: int = 80) -> Column:
    """Cut at a word's end to at most `width` signs."""
    cut = F.regexp_replace(F.substring(c, 1, width + 1), r"\s+\S*$", "")
    return F.when(F.length(c) <= width, c).otherwise(F.substring(cut, 1, width))


def has_phrase(text: Column, phrase: Column) -> Column:
    """Whole-word containment of normalised phrases."""
    return F.concat(F.lit(" "), norm_name(text), F.lit(" ")).contains(F.concat(F.lit(" "), phrase, F.lit(" ")))


def first_fraction(snippet: Column, form: Column) -> Column:
    """Where the form first stands, as a share of the snippet; 1 if nowhere."""
    at = F.call_function("instr", plain_lower(snippet), form)
    return F.when(at > 0, (at - 1) / F.greatest(F.lit(1), F.length(snippet))).otherwise(1.0)


def informativeness(snippet: Column, form: Column) -> Column:
    """0.4, up for verbs of use, constructs and an early mention, down for background phrases; clamped, four places."""
    low = plain_lower(snippet)
    use = low.rlike(START + "(?:" + "|".join(USE_VERBS) + ")" + END)
    background = low.rlike("|".join(p.replace("-", "[-]") for p in BACKGROUND))
    # what follows a point or hyphen doesn't matter: the part before it is a construct already
    construct = snippet.rlike(START + r"(?:[A-Za-z]+\d[A-Za-z0-9]*|[A-Z]{2,}\d*)" + END)
    central = round_four(1 - first_fraction(snippet, form))
    total = 0.4 + F.when(use, 0.35).otherwise(0.0) + F.when(construct, 0.15).otherwise(0.0) + 0.10 * central - F.when(background, 0.40).otherwise(0.0)
    return round_four(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))
