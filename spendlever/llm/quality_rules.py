"""Quality rules: a table of thresholds compiled into one projection.

``RULES`` names a ratio of measured counts and the range it must lie in; ``compiled`` turns
the table into one SQL condition. Counts are SQL expressions over the text alone: no user function, no
shuffle, linear in the text up to one sort of each text's word windows.

Words in repeated windows: every three-word window gets a 64-bit hash; hashes with the window's
place in their low bits are sorted, equal neighbours (compared in full) are windows found twice or more, and the
places they cover are summed up with overlaps counted once.

Defined results. Null or empty text: all counts 0, fails the base. Rows are independent, so
repeated rows get equal verdicts. Other columns are kept by ``measured`` and ``judged``; input columns of
an output's name are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from spendlever.llm.stages import without

# White space between words, symbols, and frequent function words of four languages.
BREAK = r"[\\x20\\x09-\\x0D]+"
BREAKS = " \\t\\n\\u000B\\f\\r"
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "the of and to in is that it for was with as at from by this are be on not or an a have but they his "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an "
    "le la les de des du et en un une est que qui dans pour par sur pas au avec il se ce "
    "el los las del que y un una por con para se no al lo como su es más o pero"
).split()

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_capital_words", "n_shouts"]

#: (rule, numerator, denominator, least, most); a ratio over 0 counts as 0.
RULES = [
    ("word_length", "word_chars", "n_words", 2.0, 14.0),
    ("symbols", "n_symbols", "n_words", 0.0, 0.1),
    ("duplicate_lines", "n_dup_lines", "n_lines", 0.0, 0.4),
    ("stop_words", "n_stop_words", "n_words", 0.02, 1.0),
    ("capital_words", "n_capital_words", "n_words", 0.0, 0.5),
    ("shouts", "n_shouts", "n_words", 0.0, 0.2),
]
#: The base: fewer words, or a larger percentage of words in repeated windows, fail.
LEAST_WORDS = 50
MOST_REPEATED = 50
BASE = f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words"


def compiled(rules: list[tuple[str, str, str, float, float]] = RULES) -> str:
    """One SQL condition that holds if every rule does."""
    ratio = "coalesce(try_divide({n}, {d}), 0D)"
    return " and ".join(f"{ratio.format(n=n, d=d)} between {low}D and {high}D" for _, n, d, low, high in rules)


def _count_of(text: str, characters: str) -> str:
    """Occurrences of single-byte characters."""
    return " + ".join(f"octet_length({text}) - octet_length(replace({text}, '{c}', ''))" for c in characters)


def measured(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the counts of ``MEASURES`` (long)."""
    df = without(df, *MEASURES)
    kept = df.columns
    hidden = "_".join(["", *kept])  # longer than every input name, so it can't clash
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    t, w, h, s, p, g = (f"`{x}{hidden}`" for x in "twhspg")
    one = df.selectExpr("*", f"coalesce(`{text_col}`, '') as {t}")
    two = one.selectExpr(
        "*", f"filter(split({t}, '{BREAK}'), x -> x != '') as {w}",
        f"filter(split({t}, '\\n'), x -> btrim(x, '{BREAKS}') != '') as {g}",
    )
    three = two.selectExpr(
        "*", f"if(size({w}) > 2, transform(slice({w}, 1, greatest(size({w}) - 2, 0)), "
        f"(x, i) -> xxhash64(x, get({w}, i + 1), get({w}, i + 2))), cast(array() as array<bigint>)) as {h}",
        f"length(bin(size({w}))) as `bits{hidden}`",
    )
    place = lambda x: f"cast({x} & (shiftleft(1L, `bits{hidden}`) - 1) as int)"
    four = three.selectExpr(
        "*", f"sort_array(transform({h}, (x, i) -> shiftleft(shiftright(x, `bits{hidden}`), `bits{hidden}`) | cast(i as bigint))) as {s}")
    five = four.selectExpr(
        "*", f"sort_array(transform(filter({s}, (x, i) -> get({h}, {place('x')}) <=> get({h}, {place(f'get({s}, i - 1)')}) "
        f"or get({h}, {place('x')}) <=> get({h}, {place(f'get({s}, i + 1)')})), x -> {place('x')})) as {p}")
    counts = {
        "n_words": f"size({w})",
        "word_chars": f"length(array_join({w}, ''))",
        "n_symbols": _count_of(t, SYMBOLS),
        "n_lines": f"size({g})",
        "n_dup_lines": f"size({g}) - size(array_distinct({g}))",
        "n_repeat_words": f"aggregate(transform({p}, (x, i) -> least(3, coalesce(get({p}, i + 1) - x, 3))), 0, (a, x) -> a + x)",
        "n_stop_words": f"size(filter({w}, x -> lower(x) in ({stop})))",
        "n_capital_words": f"size(filter({w}, x -> x = upper(x) and x != lower(x)))",
        "n_shouts": _count_of(t, "!"),
    }
    return five.selectExpr(*[f"`{c}`" for c in kept], *[f"cast({sql} as bigint) as {name}" for name, sql in counts.items()])


def judged(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the counts, ``base_failed`` and ``kept``."""
    return without(measured(df, text_col), "base_failed", "kept").selectExpr("*", f"({BASE}) as base_failed").selectExpr("*", f"(not base_failed and {compiled()}) as kept")
