"""Secrets in texts: fixed patterns, and values that cost much to guess (op 12).

``base_spans`` are matches of three patterns.  The method adds the values of
credential contexts (a name such as *password*, then ``:``, ``=``, ``=>``, *is*
or *was*; a bearer token; the password in a URL) that the dynamic program of
``guess_cost`` cannot cut into words, dates, repeats, keyboard walks and single
characters for less than ``BITS``.

The words are the commonest ``DICTIONARY`` of all texts, the values themselves
left out: an attacker's list, whose size is a parameter of the model as the
threshold is.  Counts cover all documents; words are ranked in steps of a
sixteenth of a bit of their count, and a step goes whole or not at all, so the
list does not depend on how the texts are dealt out.

A span of a pattern is the whole match, one of kind ``guess`` is the value.
Places are code points, ends exclusive.

Cases: a null or empty text has no spans; rows are independent, so repeated
rows and ties do not matter beyond the counts of words; null doc_ids are kept;
very long texts are scanned in one piece, very long values cost time in
proportion to their length; an empty table gives none; other columns are
carried or ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensa.llm.arrow import aside, slices, text_of
from propensa.llm.guess_cost import LONGEST_WORD, guess_bits, word_bits
from propensa.llm.words import words_of
from propensa.session import written

KINDS = ("assign", "access", "hex", "guess")
#: Least bits of a value that is taken for a secret (10 ** 10 guesses); words
#: of the list.
BITS, DICTIONARY = 33.2, 1 << 16
#: Distinct words held at once while counting.
HELD = 1 << 17
#: The base patterns.  Case is ignored in ASCII only.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")     # 16 and more; shorter matches hold no other
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGNED = 8
#: A text without any of these has neither base assignment nor context.
HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "login", "://")
#: Hexadecimal digits as ones, other bytes as zeros; and as many as make a span.
IS_HEX = bytes(c in b"0123456789abcdef" for c in range(256))
HEX_RUN = b"\1" * 32
CONTEXT = re.compile(
    r"""(?ai:(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth|login|(?:api|access|private|secret|client|auth)"""
    r"""[ _-]?(?:key|secret|token)|key))["']?[ \t]{0,8}(?P<by>[:=]=?>?|(?ai:is|was)(?=[ \t:]):?)[ \t]{0,8}"""
    r"""(?:"(?P<a>[^"\n]+)"|'(?P<b>[^'\n]+)'|(?P<c>[^\s"']+))"""
    r"""|(?ai:bearer)[ \t]+(?P<d>[A-Za-z0-9._~+/=-]+)|://[^\s:@/]*:(?P<e>[^\s@/]+)@""")
TRAILING = ".,;:!?)]}>"


def hinted(text: str) -> bool:
    low = text.lower()
    return any(h in low for h in HINTS)


def base_spans(text: str, hint: bool | None = None) -> list[tuple[int, int, str]]:
    """(start, number of the kind, end) of the base patterns, in order."""
    found = []
    if hinted(text) if hint is None else hint:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    if HEX_RUN in text.encode().translate(IS_HEX):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def values(text: str, hint: bool | None = None) -> Iterator[tuple[int, int]]:
    """Places of the values of credential contexts."""
    if not (hinted(text) if hint is None else hint):
        return
    at = 0
    while m := CONTEXT.search(text, at):
        group = m.lastgroup if m.lastgroup != "by" else "c"
        start, end = m.span(group)
        if group in "ce":
            end = start + len(text[start:end].rstrip(TRAILING))
        value = text[start:end]
        # after a verb, a word is just a word
        verb = m["by"] is not None and m["by"][0] in "iIwW"
        if value and not (verb and value.isalpha() and value[1:].islower()):
            yield start, end
        # a short value may be the name of the next one: token: password = ...
        at = start if len(value) <= LONGEST_WORD and hinted(value) else m.end()


def count_words(docs: DataFrame) -> DataFrame:
    """word, n: all words (runs of letters, digits and characters beyond
    ASCII) that are 3 to 24 letters, outside credential values.  ``docs`` has
    text (not null)."""
    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                                          ["word", "n"])

    def outside(text: str) -> str:
        if not hinted(text):
            return text
        parts, low = [], 0
        for start, end in values(text, True):
            parts.append(text[low:start])
            low = max(low, end)
        return " ".join([*parts, text[low:]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for _, texts in slices(batch):
                data = "\n".join(map(outside, texts)).encode()
                start, end, code = words_of(np.frombuffer(data, np.uint8))
                # each different word is looked at once
                _, first, n = np.unique(code, return_index=True, return_counts=True)
                for a, b, k in zip(start[first].tolist(), end[first].tolist(), n.tolist()):
                    if 3 <= b - a <= 4 * LONGEST_WORD and (word := data[a:b].decode().lower()).isalpha():
                        counts[word] += k
                if len(counts) > HELD:
                    yield rows(counts)
                    counts = Counter()
        yield rows(counts)

    return docs.select("text").mapInArrow(count, "word string, n bigint").where(
        F.length("word").between(3, LONGEST_WORD)).groupBy("word").agg(F.sum("n").alias("n"))


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The commonest words of all texts, at most ``size``, commonest first."""
    counted = written(count_words(docs).withColumn("step", F.floor(16 * F.log2("n")).cast("int")), "words")
    # a row for each sixteenth of a bit: below 1024 rows
    least, total = None, 0
    for step, n in sorted(counted.groupBy("step").count().collect(), reverse=True):
        total += n
        if total > size:
            break
        least = step
    if least is None:
        return []
    words = counted.where(F.col("step") >= least).select("word", "step").collect()
    return [r["word"] for r in sorted(words, key=lambda r: (-r["step"], r["word"]))]


def find(text: str, words: Mapping[str, float], least: float = BITS) -> list[tuple[int, int, int, float | None]]:
    """(start, number of the kind, end, bits or null) of all spans."""
    hint = hinted(text)
    found = [(*span, None) for span in base_spans(text, hint)]
    for start, end in set(values(text, hint)):
        bits = guess_bits(text[start:end], words)
        if bits >= least:
            found.append((start, 3, end, bits))
    return sorted(found, key=lambda s: s[:3])


def scan(docs: DataFrame, least: float = BITS, size: int = DICTIONARY) -> DataFrame:
    """``docs`` with its columns and ``secrets``: array of (kind, start, end,
    bits), in order; it replaces a column of that name."""
    renamed, _ = aside(docs, "text")
    whole = renamed.withColumns({"text": text_of(renamed), "no text": F.col("text").isNull()})
    # at most DICTIONARY words of 24 letters
    words = docs.sparkSession.sparkContext.broadcast(word_bits(dictionary(whole, size)))
    own = whole.columns

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost = words.value
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())]))
        for batch in batches:
            for rows, texts in slices(batch):
                found = [[{"kind": KINDS[k], "start": a, "end": b, "bits": bits} for a, k, b, bits in find(t, cost, least)]
                         for t in texts]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(found, kind)], [*own, "secrets"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.schema.fields)
    done = whole.mapInArrow(spans, f"{kinds}, secrets array<struct<kind: string, start: bigint, end: bigint, bits: double>>")
    text = F.when(~F.col("`no text`"), F.col("text")).alias("text")
    columns = [text if c == "text" else F.col(f"`{new}`").alias(c)
               for c, new in zip(docs.columns, renamed.columns) if c != "secrets"]
    return done.select(*columns, "secrets")


def written_spans(base_only: bool) -> str:
    """SQL of the spans as kind:start:end, comma-joined."""
    chosen = "filter(secrets, s -> s.kind != 'guess')" if base_only else "secrets"
    return f"array_join(transform({chosen}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"


def report(docs: DataFrame, least: float = BITS, size: int = DICTIONARY) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans and
    n_guess."""
    found = scan(docs.select("doc_id", "text"), least, size).drop("text")

    def n(kind: str):
        return F.expr(f"cast(size(filter(secrets, s -> s.kind = '{kind}')) as bigint)").alias(f"n_{kind}")

    return found.select("doc_id", n("assign"), n("access"), n("hex"),
                        F.sha2(F.expr(written_spans(True)), 256).alias("base_sha256"),
                        F.expr(written_spans(False)).alias("spans"), n("guess"))


def redact(docs: DataFrame, least: float = BITS, size: int = DICTIONARY) -> DataFrame:
    """``docs`` with its columns; each run of overlapping spans in ``text`` is
    replaced by its first kind in brackets."""
    renamed, back = aside(docs, "text")
    found = scan(renamed, least, size)
    columns = renamed.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index("text")
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("text"), batch.column("secrets")):
                text, parts, low = text.as_py(), [], 0
                for span in spans.as_py():
                    if span["start"] >= low:
                        parts += [text[low:span["start"]], f"[{span['kind']}]"]
                    low = max(low, span["end"])
                texts.append("".join([*parts, text[low:]]) if parts else text)
            arrays = [batch.column(c) for c in columns]
            arrays[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, columns)

    return back(found.mapInArrow(apply, found.drop("secrets").schema))
