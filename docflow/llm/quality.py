"""Quality rules, lines first: judge every line, take failed lines out, reject what has lost too much."""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm import texts

SYMBOLS = "#*$%&|<>"
SEPARATORS = "|•»"
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "we use cookies",
    "licensed under", "released under the", "license, version", "enable javascript", "click here", "sign up", "log in",
)
SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, "
    "n_failed_lines long, kept_chars long, base_failed boolean, kept boolean, clean_text string"
)
_TYPES = [pa.int64()] * 8 + [pa.bool_(), pa.bool_(), pa.string()]
_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
_MARKS = re.compile(r"[.!?,;:…。！？]")


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; all are shares of counts, so that they hold at any length.

    symbol_share: a line fails with more symbols than this share of its characters.
    words_per_separator: a navigation line has a separator for every so many words.
    words_per_shout: a line fails with a ``!`` or ``?`` for every so many words, two at least.
    unmarked_words: a line of so many words fails without any punctuation.
    short_words, boilerplate_percent: a line with boilerplate phrases fails if it has no more words than the first, or if the
        phrases make up this share of its characters.
    min_words, repeat_share: the base rules of a document.
    loss_share: a document is rejected if failed lines hold more than this share of its characters.
    """

    symbol_percent: int = 20
    words_per_separator: int = 4
    words_per_shout: int = 2
    unmarked_words: int = 20
    short_words: int = 10
    boilerplate_percent: int = 20
    min_words: int = 50
    repeat_percent: int = 50
    loss_percent: int = 50


def line_fails(line: str, n_words: int, chars: int, rules: Rules, phrases: list[str]) -> bool:
    """Whether a line with words is symbols, navigation, shouting, unmarked or boilerplate."""
    if 100 * sum(map(line.count, SYMBOLS)) > rules.symbol_percent * chars:
        return True
    if (n := sum(map(line.count, SEPARATORS))) and rules.words_per_separator * n >= n_words:
        return True
    if (n := line.count("!") + line.count("?")) > 1 and rules.words_per_shout * n >= n_words:
        return True
    if n_words >= rules.unmarked_words and not _MARKS.search(line):
        return True
    return bool(phrases) and is_boilerplate(line.lower(), n_words, rules, phrases)


def is_boilerplate(lower: str, n_words: int, rules: Rules, phrases: list[str]) -> bool:
    """Whether phrases, as whole words, stand in a short line or make up a share of a longer one; white space does not count."""
    spans = [m.span() for x in phrases if x in lower for m in _whole(x).finditer(lower)]
    if not spans or n_words <= rules.short_words:
        return bool(spans)
    covered = {i for start, end in spans for i in range(start, end) if lower[i] not in texts.WHITE}
    return 100 * len(covered) >= rules.boilerplate_percent * len(texts.without_white(lower))


def _whole(phrase: str) -> re.Pattern:
    """The phrase where no word goes on beyond its ends; ``re`` keeps what it has compiled."""
    return re.compile(rf"(?:(?<!\w)|(?!\w)){re.escape(phrase)}(?:(?!\w)|(?<!\w))")


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of three words that occur twice or more; the first occurrence counts too."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    hit = bytearray(len(words))
    for i, window in enumerate(windows):
        j = first.setdefault(window, i)
        if j != i:
            hit[i : i + 3] = hit[j : j + 3] = b"\1\1\1"
    return sum(hit)


def judge(text: str | None, rules: Rules, boilerplate: tuple[str, ...]) -> tuple:
    words = texts.words(text)
    text = text or ""
    squeezed = texts.without_white(text)
    lower = text.lower()
    phrases = [x for x in boilerplate if x in lower]
    seen: set[str] = set()
    kept_lines, n_lines, n_dup, n_failed, kept_chars = [], 0, 0, 0, 0
    for line in text.split("\n"):
        if not (n_words := len(texts.words(line))):
            kept_lines.append(line)
            continue
        n_lines += 1
        repeated = line in seen
        seen.add(line)
        n_dup += repeated
        chars = len(texts.without_white(line))
        if repeated or line_fails(line, n_words, chars, rules, phrases):
            n_failed += 1
        else:
            kept_lines.append(line)
            kept_chars += chars
    repeats = repeated_words(words)
    base_failed = len(words) < rules.min_words or 100 * repeats > rules.repeat_percent * len(words)
    kept = not base_failed and 100 * (len(squeezed) - kept_chars) <= rules.loss_percent * len(squeezed)
    symbols = sum(map(squeezed.count, SYMBOLS))
    return len(words), len(squeezed), symbols, n_dup, repeats, n_lines, n_failed, kept_chars, base_failed, kept, "\n".join(kept_lines)


def clean_lines(df: DataFrame, text: str = "text", result: str = "quality", rules: Rules = Rules(), boilerplate: tuple[str, ...] = BOILERPLATE) -> DataFrame:
    """``df`` with a struct ``result``: counts, verdict and the text without its failed lines.

    A line with words fails as symbols, navigation, shouting, unmarked prose, boilerplate, or as equal to an
    earlier line of its document. Lines without words stay. ``kept`` is false where the base rules fail
    (too few words, too many repeated ones) or failed lines hold more than ``loss_percent`` of all characters
    other than white space. A boilerplate phrase counts as whole words only, and fails a line of more than
    ``short_words`` words only where phrases hold ``boilerplate_percent`` of it.

    A null text counts as empty: zeros, base_failed, not kept, an empty clean text. Equal rows get equal
    results, one each; other columns, nulls in them included, pass unchanged, and a column named ``result``
    is replaced. An empty table gives an empty one. A task holds one Arrow batch of texts.
    """

    @F.arrow_udf(f"struct<{SCHEMA.replace(' ', ':').replace(',:', ',')}>")
    def run(column: pa.Array) -> pa.Array:
        rows = [judge(x, rules, boilerplate) for x in column.to_pylist()]
        columns = list(zip(*rows)) or [()] * len(_NAMES)
        return texts.struct_of(list(zip(_NAMES, map(list, columns), _TYPES)))

    return df.withColumn(result, run.asNondeterministic()(F.col(text)))


def kept_documents(df: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The documents that are kept, each with its cleaned text; same columns as ``df``."""
    done = clean_lines(df, text, "__quality", rules).filter(F.col("__quality.kept"))
    return done.withColumn(text, F.col("__quality.clean_text")).select(*[F.col(f"`{c}`") for c in df.columns])
