"""Pages made of keywords, links or tags in place of sentences.

Every line of a page's own text is measured: share of the commonest word, share of link text, density of separators, repeated
pieces, sentences and runs of words, share of function words. Thresholds are per language, found by function words rather than
by the page's own claim. A page is a case if more than half of its characters lie in lines or sentences that only string
keywords or links together or repeat one phrase.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from tidemark.llm.page_text import FUNCTION, LANGUAGE_OF, body_lines, function_share, words_of
from tidemark.session import ship_package, spread


@dataclass(frozen=True)
class Thresholds:
    """Least shares and densities.

    ``function``: function words in running text; ``top``: commonest content word in stuffed text; ``copies``: repeated sentences
    among all, above what refrains reach; ``runs``: words of sentences in repeated runs of words; ``separators``: separators per word.
    """

    function: float
    top: float
    copies: float
    runs: float
    separators: float


#: By language of the page; languages without articles have fewer function words. ``copies`` and ``runs`` lie about 0.1 above the
#: highest share on pages of sf0.1 that were no cases by the other measures, ``separators`` above the highest density, 0.5 in each language.
LANGUAGE_THRESHOLDS = {
    "en": Thresholds(0.16, 0.13, 0.60, 0.65, 0.55),
    "de": Thresholds(0.16, 0.13, 0.56, 0.65, 0.55),
    "fr": Thresholds(0.16, 0.13, 0.60, 0.73, 0.55),
    "es": Thresholds(0.16, 0.13, 0.59, 0.63, 0.55),
    "pl": Thresholds(0.10, 0.13, 0.59, 0.61, 0.55),
    "ru": Thresholds(0.08, 0.13, 0.55, 0.60, 0.55),
}
#: Least number of pieces in a row of keywords, and of repetitions of a stuffed word.
LEAST_PIECES, LEAST_REPEATS = 6, 8

#: Words in a run, least number of times a run or a sentence comes again, least share of the sentences that hold a repeated run,
#: and copies of a sentence on end that no refrain has.
RUN, LEAST_RUNS, LEAST_COPIES, RUN_SHARE, ON_END = 5, 4, 3, 0.1, 4

_URL = re.compile(r"(?i)\b(?:https?://|ftp://|www\.)\S+|\b(?:[a-z0-9-]{1,63}\.){1,6}[a-z]{2,8}/\S*|\b(?:[a-z0-9-]{1,63}\.){1,6}(?:example|test|invalid|com|org|net|info|biz)\b")
_BBCODE = re.compile(r"(?i)\[/?url[^\[\]]*\]")
_MARKDOWN = re.compile(r"\[([^\[\]\n]*)\]\(([^()\n]*)\)")
_REFERENCE = re.compile(r"^\s*\[\d+\]|^\s*\(?\d+[.)]\s")
_LABEL = re.compile(r"(?i)^\s*(?:tags?|keywords?|labels?|schlagw\w+|mots[- ]cl\w+|etiquetas?|tagi|теги|метки)\s*[:=]")
_PIECES = re.compile(r"(?<=[.!?…])\s+|\s?[|·»«•;/→]+\s?|\s[-–—]+\s|\s{2,}|[()]")
#: Signs that stand between keywords without being blanks or commas.
_SEPARATOR = re.compile(r"[|·»«•;/→*~+^=<>\\_]")
_SENTENCE_END = re.compile(r"[.!?…][\"”»')]*$")
#: Rows of facts: times, amounts with units, name and value, log lines, posts with author and time.
_FACT = re.compile(r"^\W*\d{1,2}:\d\d|^\W*\d+(?:[.,]\d+)?\s*(?:[^\W\d_]{1,4}\b|[€$£%])\s+\S|^[^\W\d_]+(?: [^\W\d_]+)?\s*[:=]\s*[^\s;|]+(?:\s+[^\W\d_]{1,3})?$|\w_\d{1,9},\s?\d|\w=\d|\d{1,2}[:.]\d\d$")
_DIGIT = re.compile(r"\d")
_DOTTED = re.compile(r"[A-Za-z0-9]\.[A-Za-z]")
_SPACED = re.compile(r"\b\w \w \w\b")
_MIXED = re.compile(r"[^\W\d_]\d|\d[^\W\d_]")
_LEETED = re.compile(r"\b(?=\w*[^\W\d_])(?=\w*\d)\w+\b")
_LEET = str.maketrans("013457", "oieast")


def _plain(text: str) -> str:
    """Without disguises: letters set apart by spaces are joined, digits inside words become the letters they stand for."""
    if _SPACED.search(text):
        text = re.sub(r"\b\w(?: \w\b)+", lambda m: m[0].replace(" ", ""), text)
    return _LEETED.sub(lambda m: m[0].translate(_LEET), text)


def page_language(words: list[str]) -> str | None:
    found = Counter(LANGUAGE_OF[w] for w in words if w in FUNCTION)
    return found.most_common(1)[0][0] if found else None


def _is_names(pieces: list[str]) -> bool:
    """Rows of proper names: every word has a capital and hardly any comes again."""
    words = [w for p in pieces for w in re.findall(r"[^\W\d_]+", p)]
    return bool(words) and all(w[0].isupper() and not w.isupper() for w in words) and len(set(words)) > 0.75 * len(words)


def _repeated(sentences: list[tuple[str, list[str], int]], limits: Thresholds) -> set[int]:
    """Places of sentences that only repeat one phrase: copies, or the same long runs of words with other words between them.

    Copies up to the share ``copies`` may be a refrain, unless they follow on each other. Of sentences that differ in a few words,
    those with digits there inform, and those with twice the function words of running text are verses, entries and the like.
    """
    long = [(i, tuple(ws), len(t)) for i, (t, ws, _) in enumerate(sentences) if len(ws) >= 4]
    if len(long) < LEAST_COPIES:
        return set()
    chars = sum(n for *_, n in long)
    tally = Counter(ws for _, ws, _ in long)
    copied = [x for x in long if tally[x[1]] >= LEAST_COPIES]
    found = set()
    if sum(n for *_, n in copied) > limits.copies * chars:
        found |= {i for i, *_ in copied}
    elif copied:
        start = 0
        for end in range(1, len(long) + 1):
            if end == len(long) or long[end][1] != long[start][1]:
                if end - start >= ON_END:
                    found |= {i for i, *_ in long[start:end]}
                start = end
    runs: Counter[tuple[str, ...]] = Counter()
    for _, ws, _ in long:
        runs.update(set(zip(*(ws[k:] for k in range(RUN)))))
    least = max(LEAST_RUNS, RUN_SHARE * len(long))
    often = {run for run, n in runs.items() if n >= least}
    if not often:
        return found
    within, covered = [], 0
    for i, ws, _ in long:
        hit = [False] * len(ws)
        for k, run in enumerate(zip(*(ws[k:] for k in range(RUN)))):
            if run in often:
                hit[k : k + RUN] = [True] * RUN
        covered += sum(hit)
        if 2 * sum(hit) >= len(ws) and function_share(list(ws)) < 2 * limits.function and not any(_DIGIT.search(w) for w, h in zip(ws, hit, strict=True) if not h):
            within.append(i)
    return found | set(within) if covered > limits.runs * sum(len(ws) for _, ws, _ in long) else found


def _is_labels(labels: list[list[str]]) -> bool:
    """Whether short labels of links turn around one content word, as those of references never do."""
    tally = Counter(w for ws in labels for w in {*ws} if w not in FUNCTION and not w.isdigit())
    return len(labels) >= LEAST_PIECES and sum(len(ws) <= 5 for ws in labels) >= 0.8 * len(labels) and bool(tally) and tally.most_common(1)[0][1] >= 0.5 * len(labels)


def keyword_share(text: str | None, raw: bytes | None) -> float:
    """Share of the page's own characters that lie in strung-together keywords, links or tags; 0 for a page without text."""
    lines = body_lines(text, raw)
    total = sum(map(len, lines))
    if not total:
        return 0.0
    whole = " ".join(lines)
    links = "://" in whole or "](" in whole or _DOTTED.search(whole)
    plain = _plain if _SPACED.search(whole) or _MIXED.search(whole) else str
    limits = LANGUAGE_THRESHOLDS.get(page_language(words_of(whole)) or "en", LANGUAGE_THRESHOLDS["en"])
    spam = 0
    sentences: list[tuple[str, list[str], int]] = []  # text, words, line
    on_line: dict[int, list[str]] = {}  # words of lines with sentences
    items: list[tuple[str, list[str]]] = []  # pieces that are no sentences
    bare: list[tuple[int, int]] = []  # characters and links of lines that are only links
    numbered: list[tuple[int, int, list[str]]] = []  # characters, links and words of numbered lines with links
    for number, line in enumerate(lines):
        if links and ("://" in line or "](" in line or _DOTTED.search(line) and _URL.search(line)):
            shown = _BBCODE.sub(" ", _MARKDOWN.sub(r" \1 ", line))
            rest = _URL.sub(" ", shown)
            words = words_of(rest)
            if _REFERENCE.match(line):
                numbered.append((len(line), len(_URL.findall(shown)) or 1, [w for w in words if not w.isdigit()]))
                continue  # a reference with its source, unless all are labelled with a keyword
            if len(words) >= 5 and function_share(words) >= limits.function:
                link_text = len(line) - len(rest)
                per_link = len(words) / max(1, len(_URL.findall(shown)))
                if per_link >= 4:
                    sentences.append((rest, words, number))
                    on_line[number] = words
                    continue
                spam += link_text
                line = rest
            elif len(rest.strip()) > 0.6 * len(line):  # a row of words with a link in it
                line = rest
            else:
                bare.append((len(line), len(_URL.findall(shown)) or 1))
                continue
        if line.startswith("#") and line.count("#") >= 2 or line.count(" #") >= 3:
            spam += len(line)
            continue
        if _LABEL.match(line):
            labels = [p for p in re.split(r"[,;|]", line.split(":", 1)[-1]) if p.strip()]
            items += [(p, words_of(plain(p))) for p in labels] if len(labels) < LEAST_PIECES else []
            spam += len(line) if len(labels) >= LEAST_PIECES else 0
            continue
        if (":" in line or "=" in line or _DIGIT.search(line)) and _FACT.search(line) and not re.search(r"(?i)\btop \d+\b", line):
            continue
        dense = len(_SEPARATOR.findall(line))
        if dense >= LEAST_PIECES and dense > limits.separators * len(words_of(line)):
            items += [(p, words_of(p)) for p in map(plain, _SEPARATOR.split(line)) if words_of(p)]
            continue
        for piece in _PIECES.split(line):
            if not piece or not piece.strip():
                continue
            text_of = plain(piece)
            words = words_of(text_of)
            if not words:
                continue
            commas = [c for c in text_of.split(",") if c.strip()]
            listed = len(commas) >= 4 and len(words) <= 3.5 * len(commas)
            ended = bool(_SENTENCE_END.search(piece)) and len(words) >= 4 and not piece.lstrip("\"“„«¿¡'(—– ")[:1].islower()
            if not listed and (ended or len(words) >= 6 and function_share(words) >= limits.function):
                sentences.append((piece, words, number))
                on_line.setdefault(number, words_of(plain(line)))
            elif listed:
                items += [(c, words_of(c)) for c in commas]
            else:
                items.append((piece, words))
    if _is_labels([ws for *_, ws in numbered]):
        bare += [x[:2] for x in numbered]
    described = sum(1 for _, w, _ in sentences if len(w) >= 5)
    # a list of links in which each has its sentence on another line informs
    if described < 0.7 * sum(n for _, n in bare):
        spam += sum(n for n, _ in bare)
    content = [w for x in (*sentences, *items) for w in x[1] if w not in FUNCTION and not w.isdigit()]
    counts = Counter(content)
    least = lambda n: n >= LEAST_REPEATS and n >= limits.top * len(content) or n >= 5 and n >= 0.22 * len(content)
    top = {w for w, n in counts.items() if least(n)}
    turning = _repeated(sentences, limits)
    if top:  # sentences that turn around one phrase
        stuffed = {n for n, ws in on_line.items() if (hits := sum(w in top for w in ws)) >= 3 and hits >= limits.top * sum(w not in FUNCTION for w in ws)}
        turning |= {i for i, (_, ws, n) in enumerate(sentences) if n in stuffed or (hits := sum(w in top for w in ws)) >= 2 or hits and len(ws) <= 5 * hits}
    spam += sum(len(sentences[i][0]) for i in turning)
    if items:
        item_words = [w for _, ws in items for w in ws if not w.isdigit()]
        tally = Counter(item_words)
        most = tally.most_common(1)[0][1] if tally else 0
        repeated = most >= 4 and (most >= 0.1 * len(item_words) or len(tally) <= 0.7 * len(item_words))
        lower = sum(t.strip()[:1].islower() for t, _ in items)
        if not _is_names([t for t, _ in items]) and (repeated or len(items) >= LEAST_PIECES and lower >= 0.15 * len(items)):
            spam += sum(len(t) + 2 for t, _ in items)
    return min(1.0, spam / total)


def keyword_pages(documents: DataFrame, least_share: float = 0.5) -> DataFrame:
    """``(doc_id, spam_share)`` of pages with more than ``least_share`` of keywords, links or tags.

    Needs ``doc_id``, ``text`` and, where the page's bytes are kept, ``raw``. Pages without text are no cases. Rows are judged
    one by one in Arrow batches: no shuffle, no state, so neither size nor skew matters beyond the longest page.
    """
    has_raw = "raw" in documents.columns

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raws = batch["raw"] if has_raw else [None] * len(batch)
            shares = [keyword_share(t, r) for t, r in zip(batch["text"], raws, strict=True)]
            out = pd.DataFrame({"doc_id": batch["doc_id"], "spam_share": shares})
            yield out[out.spam_share > least_share]

    ship_package(documents.sparkSession)
    columns = ["doc_id", "text", *["raw"] * has_raw]
    return spread(documents.filter("text IS NOT NULL AND text <> ''").select(*columns)).mapInPandas(judge, "doc_id bigint, spam_share double")
