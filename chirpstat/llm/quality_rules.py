"""Operator 4: line-first cleaning.

Every line is judged on its own by punctuation, navigation and boilerplate
rules; lines that fail are removed, and a document that loses too much of its
text this way is rejected. A document that is too short or mostly made of
repeated word triples is rejected by the base rules.

Words are runs of characters other than ASCII white space. Lines are the parts
between line feeds. Defined results: a null text is an empty one (no words, so
base_failed); rows with equal ids are judged one by one; an empty table gives
an empty result; only doc_id and text are read, other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.llm.common import table

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MARKED_WORD = r"[^\x20\x09-\x0D]*(?:[#*$%&|<>]|!!)[^\x20\x09-\x0D]*"
SENTENCE_MARK = r"[.!?:;,]"
END_MARK = r"[.!?:;,\"')\]][\x20\x09-\x0D]*$"
NAVIGATION = (
    r"(?i)^[\x20\x09-\x0D]*(?:home|menu|next|previous|prev|back|search|login|log in|sign in|sign up|register|share|print|"
    r"top|more|read more|contact|contact us|about|about us|help|sitemap|skip to content)[\x20\x09-\x0D]*$"
)
BOILERPLATE = (
    r"(?i)all rights reserved|terms of (?:use|service)|privacy policy|cookie policy|uses cookies|accept cookies|"
    r"enable javascript|javascript is disabled|lorem ipsum|click here|subscribe to our|copyright (?:\(c\)|[0-9]{4})|"
    r"powered by|follow us on"
)


@dataclass(frozen=True)
class Rules:
    """Thresholds of the base rules and of the line rules."""

    min_words: int = 50
    #: base rule: percent of words in repeated 3-word windows
    max_repeat_percent: int = 50
    #: a line fails if more than this percent of its words carry symbols or "!!"
    max_marked_percent: int = 30
    #: a longer line with no sentence mark at all fails
    max_unmarked_words: int = 30
    #: a short line without a closing mark that holds a separator is navigation
    max_nav_words: int = 8
    #: a document that loses more than this percent of its words is rejected
    max_lost_percent: int = 50


_WORD = re.compile(WORD)
_MARKED = re.compile(MARKED_WORD)
_ANY_MARK = re.compile(r"[#*$%&|<>]|!!")
_SENTENCE = re.compile(SENTENCE_MARK)
_END = re.compile(END_MARK)
_NAV = re.compile(NAVIGATION, re.ASCII)
_BOILER = re.compile(BOILERPLATE, re.ASCII)
_SEPARATOR = re.compile("[|>»›·•]")
#: Every boilerplate phrase holds one of these, so a text without them needs no search per line.
_BOILER_PARTS = (
    "rights reserved", "terms of", "privacy policy", "cookie", "javascript", "lorem ipsum", "click here",
    "subscribe to our", "copyright", "powered by", "follow us on",
)


def line_fails(line: str, n_words: int, rules: Rules, boilerplate: bool = True) -> bool:
    """Whether a line with n_words > 0 words breaks a line rule (boilerplate: phrases may occur)."""
    if _ANY_MARK.search(line) and 100 * len(_MARKED.findall(line)) > rules.max_marked_percent * n_words:
        return True
    if n_words > rules.max_unmarked_words and not _SENTENCE.search(line):
        return True
    if n_words <= rules.max_nav_words and (_NAV.search(line) or (_SEPARATOR.search(line) and not _END.search(line))):
        return True
    return boilerplate and _BOILER.search(line) is not None


def repeated_words(words: list[str]) -> int:
    """Words inside 3-word windows that occur at least twice."""
    n = len(words)
    if n < 4:
        return 0
    seen = {w: i for i, w in enumerate(dict.fromkeys(words))}
    if len(seen) > n - 3:  # a window that comes twice repeats three words, or one word three times over
        return 0
    ids = np.fromiter(map(seen.__getitem__, words), np.int64, n)
    pairs = ids[:-2] * len(seen) + ids[1:-1]
    if len(seen) > 1_000_000:  # keep the keys below 2**63
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs * len(seen) + ids[2:]
    order = np.argsort(windows, kind="stable")
    equal = np.diff(windows[order]) == 0
    if not equal.any():
        return 0
    hit = np.zeros(n - 2, bool)
    hit[order[1:][equal]] = hit[order[:-1][equal]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= hit
    return int(covered.sum())


def judge(text: str | None, rules: Rules = Rules()) -> tuple[int, int, int, int, int, bool, bool, str]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, cleaned text."""
    text = text or ""
    words: list[str] = []
    lines: list[str] = []
    seen: set[str] = set()
    duplicates = lost = 0
    lower = text.lower()
    boilerplate = any(part in lower for part in _BOILER_PARTS)
    for line in text.split("\n"):
        own = _WORD.findall(line)
        if not own:
            lines.append(line)
            continue
        words += own
        if line in seen:
            duplicates += 1
        seen.add(line)
        if line_fails(line, len(own), rules, boilerplate):
            lost += len(own)
        else:
            lines.append(line)
    n = len(words)
    repeated = repeated_words(words)
    failed = n < rules.min_words or 100 * repeated > rules.max_repeat_percent * n
    kept = not failed and 100 * lost <= rules.max_lost_percent * n
    symbols = sum(text.count(c) for c in SYMBOLS)
    return n, sum(map(len, words)), symbols, duplicates, repeated, failed, kept, "\n".join(lines)


METRICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"


def clean_documents(docs: DataFrame, rules: Rules = Rules(), with_text: bool = True) -> DataFrame:
    """doc_id, the measures, the verdict and (with_text) the text without failed lines."""
    names = [c.split()[0] for c in METRICS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [judge(t, rules)[: None if with_text else -1] for t in batch["text"]]
            out = pd.DataFrame(rows, columns=[*names, *["cleaned"] * with_text])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64"))
            yield out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(run, f"doc_id long, {METRICS}" + ", cleaned string" * with_text)


def op4_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return clean_documents(table(spark, sf_dir, "documents"), with_text=False)


_R = Rules()
#: The same measures and verdict in DuckDB.
OP4_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT r, generate_subscripts(parts, 1) AS k, unnest(parts) AS line FROM (SELECT r, string_split(text, chr(10)) AS parts FROM d)),
m AS (SELECT r, k, line, len(regexp_extract_all(line, '{WORD}')) AS n,
             len(regexp_extract_all(line, '{MARKED_WORD}')) AS marked FROM l),
j AS (SELECT r, n, row_number() OVER (PARTITION BY r, line ORDER BY k) > 1 AS dup,
             100 * marked > {_R.max_marked_percent} * n
             OR (n > {_R.max_unmarked_words} AND NOT regexp_matches(line, '{SENTENCE_MARK}'))
             OR (n <= {_R.max_nav_words} AND (regexp_matches(line, '{NAVIGATION}')
                 OR (regexp_matches(line, '[|>»›·•]') AND NOT regexp_matches(line, '{END_MARK.replace("'", "''")}'))))
             OR regexp_matches(line, '{BOILERPLATE}') AS bad
      FROM m WHERE n > 0),
a AS (SELECT r, sum(dup::INT) AS dups, coalesce(sum(n) FILTER (bad), 0) AS lost FROM j GROUP BY r),
w AS (SELECT r, regexp_extract_all(text, '{WORD}') AS ws FROM d),
g AS (SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
t AS (SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2]) AS c FROM g),
p AS (SELECT r, count(DISTINCT i + s) AS n FROM t, (SELECT unnest([0, 1, 2]) AS s) WHERE c > 1 GROUP BY r),
b AS (SELECT d.r, d.doc_id, len(ws) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(dups, 0) AS n_dup_lines,
             coalesce(p.n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
      FROM d JOIN w USING (r) LEFT JOIN a USING (r) LEFT JOIN p USING (r)),
f AS (SELECT *, n_words < {_R.min_words} OR 100 * n_repeat_words > {_R.max_repeat_percent} * n_words AS base_failed FROM b)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost <= {_R.max_lost_percent} * n_words AS kept
FROM f
"""
