"""Removal of sentences that lie in spans repeated across documents.

From every sentence on, the run of consecutive sentences with at least ``MIN_WORDS`` words is one
span, known by the hash of its first ``MIN_WORDS`` lower-cased words. Spans are joined globally
by their hash. A span that was seen before, in a document of a smaller id or earlier in the same
text, is extended word by word to both sides as far as the first document that holds it reads
the same (``CONTEXT`` words at most, which is more than lies between two spans), and what is
covered goes.

Sentences end behind a word that ends in ``.``, ``!`` or ``?`` and at line breaks. Only a sentence
of more than ``LONG_WORDS`` words is cut further, behind the last word of smallest hash in each
window of so many words, which depends on the words of the window alone. So a passage that two
documents share (with its line breaks) holds a common start behind at most ``LONG_WORDS + 1`` words,
and every repeated run of ``LONG_WORDS + 1 + MIN_WORDS`` words (46) is found.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import tokens
from tramline.session import broadcast_if_small, cut_lineage

MIN_WORDS = 20
LONG_WORDS = 25
#: Words before and behind a span that are compared with the first document's.
CONTEXT = 64
#: Stands for a missing id, which comes after all others.
NO_ID = 2**63 - 1

_WORD = re.compile(r"\S+")
_FOUND = "doc long, version long, n_sentences long, again boolean, hashes array<long>"
_RESULT = "doc_id long, n_sentences long, n_removed long, removed array<long>, text string"


def window_minima(words: list[str]) -> list[int]:
    """Places of the last smallest hash in every window of ``LONG_WORDS`` words, in order."""
    hashes = [zlib.crc32(word.encode()) for word in words]
    out, least, low = [], -1, 0
    for end in range(LONG_WORDS, len(hashes) + 1):
        start = end - LONG_WORDS
        if least < start:
            low = min(hashes[start:end])
            least = end - 1 - hashes[start:end][::-1].index(low)
        elif hashes[end - 1] <= low:
            least, low = end - 1, hashes[end - 1]
        else:
            continue
        out.append(least)
    return out


def sentences(text: str) -> tuple[list[str], list[int]]:
    """All lower-cased words of a text, and the places of the words that begin a sentence or part."""
    words: list[str] = []
    starts: list[int] = []
    for line in text.lower().split("\n"):
        own, base = line.split(), len(words)
        if not own:
            continue
        edges = [0, *(i for i, word in enumerate(own, 1) if word[-1] in ".!?")]
        if edges[-1] != len(own):
            edges.append(len(own))
        for a, b in zip(edges, edges[1:], strict=False):
            starts.append(base + a)
            if b - a > LONG_WORDS:
                starts += [base + a + i + 1 for i in window_minima(own[a:b]) if a + i + 1 < b]
        words += own
    return words, starts


def spans(words: list[str], starts: list[int]) -> list[tuple[int, int]]:
    """Start and signed hash of every span, in order."""
    last, out = len(words) - MIN_WORDS, []
    for s in starts:
        if s > last:
            break
        digest = xxhash.xxh64_intdigest(" ".join(words[s : s + MIN_WORDS]).encode())
        out.append((s, digest - (1 << 64) if digest >> 63 else digest))
    return out


def _agree(one, other) -> int:
    """How many words two sequences have in common from their beginning on."""
    n = 0
    for a, b in zip(one, other, strict=False):
        if a != b:
            break
        n += 1
    return n


def _regions(own: list[tuple[int, int]], repeated: set[int]) -> list[tuple[int, int, int | None, int | None]]:
    """First and last span of every run of overlapping repeated spans, with the places where these
    two were seen before in the same text (None: in another document)."""
    seen: dict[int, int] = {}
    out: list = []
    for s, digest in own:
        before = seen.setdefault(digest, s)
        if before == s and digest not in repeated:
            continue
        place = None if digest in repeated else before
        if out and s <= out[-1][1] + MIN_WORDS:
            out[-1] = (out[-1][0], s, out[-1][2], place)
        else:
            out.append((s, s, place, place))
    return out


def covered(words: list[str], own: list[tuple[int, int]], repeated: set[int], contexts: dict) -> list[tuple[int, int]]:
    """Ranges of words that go. ``contexts`` has the words before and behind a hash in its first document."""
    hashes, out, at = dict(own), [], 0
    for first, last, left, right in _regions(own, repeated):
        end = last + MIN_WORDS
        if left is None:
            before = contexts.get(hashes[first], ("", ""))[0].split()
        else:
            before = words[max(0, left - CONTEXT) : left]
        if right is None:
            behind = contexts.get(hashes[last], ("", ""))[1].split()
        else:
            behind = words[right + MIN_WORDS : right + MIN_WORDS + CONTEXT]
        begin = max(at, first - _agree(reversed(words[at:first]), reversed(before)))
        at = end + _agree(words[end : end + CONTEXT], behind)
        out.append((begin, at))
    merged: list[tuple[int, int]] = []
    for begin, end in out:
        if merged and begin <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((begin, end))
    return merged


def document_spans(docs: DataFrame) -> DataFrame:
    """``doc, version, n_sentences, again, hashes`` of every row.

    ``version`` is the text's hash, ``hashes`` are those of the row's distinct spans, ``again``
    tells whether one stands twice in the text.
    """

    def compute(batches):
        for batch in tokens.slices(batches):
            counts, again, hashes = [], [], []
            for text in tokens.texts_of(batch):
                words, starts = sentences(text)
                all_hashes = [h for _, h in spans(words, starts)]
                own = list(dict.fromkeys(all_hashes))
                counts.append(len(starts))
                again.append(len(own) < len(all_hashes))
                hashes.append(own)
            columns = [pa.array(counts, pa.int64()), pa.array(again, pa.bool_()), pa.array(hashes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("version"), *columns], ["doc", "version", "n_sentences", "again", "hashes"]
            )

    return docs.select("text", "doc", "version").mapInArrow(compute, _FOUND)


def _asked(batches):
    """Hashes at the ends of what repeats, where words remain beside them."""
    for batch in tokens.slices(batches):
        rows: list[list] = [[], [], []]
        columns = [batch.column(c).to_pylist() for c in ("doc", "version", "text", "repeated")]
        for doc, version, text, repeated in zip(*columns, strict=True):
            words, starts = sentences(text)
            own = spans(words, starts)
            hashes, wanted = dict(own), set()
            for first, last, left, right in _regions(own, set(repeated)):
                if left is None and first:
                    wanted.add(hashes[first])
                if right is None and last + MIN_WORDS < len(words):
                    wanted.add(hashes[last])
            for column, values in zip(rows, ([doc] * len(wanted), [version] * len(wanted), wanted), strict=True):
                column += values
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], ["doc", "version", "hash"])


def _contexts(batches):
    """Words before and behind the first place of wanted hashes."""
    for batch in tokens.slices(batches):
        rows: list[list] = [[], [], []]
        for text, wanted in zip(tokens.texts_of(batch), batch.column("wanted").to_pylist(), strict=True):
            words, starts = sentences(text)
            left = set(wanted)
            for s, digest in spans(words, starts):
                if digest in left:
                    left.remove(digest)
                    rows[0].append(digest)
                    rows[1].append(" ".join(words[max(0, s - CONTEXT) : s]))
                    rows[2].append(" ".join(words[s + MIN_WORDS : s + MIN_WORDS + CONTEXT]))
        types = [pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], ["hash", "before", "behind"])


def _remove(batches):
    names = ["doc_id", "n_sentences", "n_removed", "removed", "text"]
    for batch in tokens.slices(batches):
        rows: list[list] = [[] for _ in names[2:]]
        columns = [batch.column(c).to_pylist() for c in ("text", "again", "repeated", "contexts")]
        for text, again, repeated, contexts in zip(*columns, strict=True):
            if not again and not repeated:
                for column, value in zip(rows, (0, [], text), strict=True):
                    column.append(value)
                continue
            words, starts = sentences(text)
            known = {c["hash"]: (c["before"], c["behind"]) for c in contexts or ()}
            ranges = covered(words, spans(words, starts), set(repeated or ()), known)
            places = [m.start() for m in _WORD.finditer(text)] + [len(text)]
            ends = [*starts[1:], len(words)]
            kept, at, cut, touched, i = [], 0, [], 0, 0
            for begin, end in ranges:
                kept.append(text[at : places[begin]])
                at = places[end]
                cut += [places[begin], at]
                while i < len(starts) and starts[i] < end:
                    touched += ends[i] > begin
                    i += 1
            for column, value in zip(rows, (touched, cut, "".join(kept) + text[at:]), strict=True):
                column.append(value)
        types = [pa.int64(), pa.list_(pa.int64()), pa.string()]
        made = [pa.array(c, t) for c, t in zip(rows, types, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_sentences"), *made], names)


def remove_repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, n_sentences, n_removed, removed, text`` for every row of ``docs``.

    ``n_removed`` counts the sentences (parts of long ones) of which all or some words go,
    ``removed`` lists start and end of the removed ranges in turn (code points of the old text),
    ``text`` is what stays. A null text stays null and has no sentences. Rows that share
    an id are one document, rows without an id are one document after all others: what they
    share among each other stays, unless it is repeated inside one text. Only ``doc_id`` and
    ``text`` are read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text").select(
        "*", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("version")
    )
    row = ["doc", "version"]
    # read twice, so written once
    found = cut_lineage(document_spans(docs))
    each = found.select(*row, F.explode("hashes").alias("hash"))
    first = each.groupBy("hash").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("last > first")
    first = broadcast_if_small(cut_lineage(first.select("hash", "first")))
    # all places of the hashes that several documents hold
    held = cut_lineage(each.join(first, "hash"))
    repeated = cut_lineage(held.filter("doc > first").groupBy(row).agg(F.collect_set("hash").alias("repeated")))

    matched = docs.join(repeated, row).select("doc", "version", "text", "repeated")
    asked = cut_lineage(matched.mapInArrow(_asked, "doc long, version long, hash long").distinct())
    owners = held.filter("doc = first").groupBy("hash").agg(F.min("doc").alias("doc"), F.min("version").alias("version"))
    wanted = asked.select("hash").distinct().join(owners, "hash").groupBy(row).agg(F.collect_set("hash").alias("wanted"))
    contexts = docs.join(wanted, row).select("text", "wanted").mapInArrow(_contexts, "hash long, before string, behind string")
    contexts = contexts.dropDuplicates(["hash"])
    answers = asked.join(contexts, "hash").groupBy(row).agg(F.collect_list(F.struct("hash", "before", "behind")).alias("contexts"))

    known = found.groupBy(row).agg(F.max("n_sentences").alias("n_sentences"), F.max("again").alias("again"))
    known = known.join(repeated, row, "left").join(answers, row, "left")
    joined = docs.join(known, row).select("doc_id", "text", "n_sentences", "again", "repeated", "contexts")
    return joined.mapInArrow(_remove, _RESULT)
