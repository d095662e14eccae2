"""License scan by conditional compression (operator 8).

Candidate blocks are the word ranges that a template would fill if one of
its cue words stood where the text has that word. Each block is compressed
alone and with each template as a raw zstandard dictionary; templates are
ranked by the share of the size that the dictionary saves. All whose words
can still be in the block, by their counts, are confirmed by the exact
differences in wording: at least nine tenths of
the template's words must stand in the block in order (in templates below
ten words: all of them), with at most a tenth of foreign words between
them. Among confirmed templates whose wording covers the cue word the one with
the longest common wording wins, then the one with fewest differences.

Words are runs of letters, digits and inner points and hyphens, compared
in lower case, so line breaks, punctuation and case do not matter.

Results in special cases: null and empty texts and texts without a cue
word have no findings; findings of one text never overlap; repeated rows
have repeated findings; an empty table gives an empty result; other
columns are not used.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import Memo, text_or_empty
from tallyhouse.llm.license_texts import CUES, TEMPLATES

FINDING = ("license string, start int, end int, words int, saved double, differences array<string>")
_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


@dataclass(frozen=True)
class Finding:
    """A licence at text[start:end]; ``words`` of its wording are there,
    ``saved`` is the share of the block's size that its template saves and
    ``differences`` are words missing (-) or foreign (+)."""

    license: str
    start: int
    end: int
    words: int
    saved: float
    differences: tuple[str, ...]


class Template:
    def __init__(self, name: str, text: str):
        self.name, self.words = name, [w.lower() for w in _WORD.findall(text)]
        self.cues = {c: [i for i, w in enumerate(self.words) if w == c] for c in CUES if c in self.words}
        if not self.cues:
            raise ValueError(f"template without a cue word: {text}")
        self.first = {c: at[0] for c, at in self.cues.items()}
        self.counts = Counter(self.words)
        raw = " ".join(self.words).encode()
        known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.press = zstandard.ZstdCompressor(level=9, dict_data=known, write_content_size=False, write_dict_id=False)

    @property
    def foreign(self) -> int:
        return len(self.words) // 10

    def can_fit(self, block: list[str]) -> bool:
        """Whether the block has enough of the template's words in any order;
        no wording has more words in common than that."""
        return len(self.words) - (self.counts & Counter(block)).total() <= len(self.words) // 10


class Scanner:
    def __init__(self, templates: Sequence[tuple[str, str]]):
        self.templates = [Template(*t) for t in templates]
        self.plain = zstandard.ZstdCompressor(level=9, write_content_size=False)
        self.memo = Memo(20_000)

    def saving(self, template: Template, block: list[str]) -> float:
        raw = " ".join(block).encode()
        return 1 - len(template.press.compress(raw)) / len(self.plain.compress(raw))

    @staticmethod
    def wording(template: Template, block: list[str]) -> tuple[int, int, int, tuple[str, ...]] | None:
        """(words, first, end, differences) if the block holds the wording."""
        matcher = SequenceMatcher(None, template.words, block, autojunk=False)
        same = [m for m in matcher.get_matching_blocks() if m.size]
        if not same:
            return None
        first, end = same[0].b, same[-1].b + same[-1].size
        common = sum(m.size for m in same)
        missing = len(template.words) - common
        if missing > len(template.words) // 10 or end - first - common > template.foreign:
            return None
        found = []
        for kind, i, j, k, n in matcher.get_opcodes():
            if kind != "equal":
                found += [f"-{w}" for w in template.words[i:j]]
                found += [f"+{w}" for w in block[max(k, first):min(n, end)]]
        return common, first, end, tuple(found)

    def confirmed(self, words: list[str], at: int) -> list[tuple]:
        """(name, first word, end word, common words, saving, differences) of
        every licence whose wording covers the cue at word ``at``, best first."""
        ranked = []
        for t in self.templates:
            for offset in t.cues.get(words[at], ()):
                slack = t.foreign + len(t.words) // 10
                low = max(0, at - offset - slack)
                block = words[low:at - offset + len(t.words) + slack]
                ranked.append((self.saving(t, block), len(t.words), t, low, block))
        ranked.sort(key=lambda r: (-r[0], -r[1]))
        confirmed = []
        for saved, _, t, low, block in ranked:
            if t.can_fit(block) and (same := self.wording(t, block)) is not None:
                common, first, end, differences = same
                if low + first <= at < low + end:  # otherwise it is another cue's
                    confirmed.append((-common, len(differences), -saved, t.name, low + first, low + end, differences))
        return [(name, first, end, -common, -saved, differences)
                for common, _, saved, name, first, end, differences in sorted(set(confirmed))]

    def scan(self, text: str) -> list[Finding]:
        spans = [m.span() for m in _WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in spans]
        cues = [i for i, w in enumerate(words) if w in CUES]
        reach = 2 * max(len(t.words) for t in self.templates)
        found: list[tuple] = []
        for at in cues:
            if found and at < found[-1][2]:
                continue  # inside the wording of the finding before
            low = max(0, at - reach)
            around = tuple(words[low:at + reach])
            key = (at - low, around)
            for k in self.memo.missing([key]):
                self.memo.now[k] = self.confirmed(list(around), at - low)
            for name, first, end, common, saved, differences in self.memo.now[key]:
                first, end = first + low, end + low
                apart = len(found)
                while apart and first < found[apart - 1][2]:
                    apart -= 1
                if all(common > f[3] for f in found[apart:]):
                    found[apart:] = [(name, first, end, common, saved, differences)]
                    break
        return [Finding(name, spans[a][0], spans[b - 1][1], common, saved, differences)
                for name, a, b, common, saved, differences in found]


@lru_cache(maxsize=2)
def _scanner(templates: tuple[tuple[str, str], ...]) -> Scanner:
    return Scanner(templates)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """One row per finding: doc_id, license, start and end (characters of
    the text), words, saved, differences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(templates)
        for b in batches:
            out = [(i, f) for i, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()) for f in scanner.scan(text)]
            columns = [[i for i, _ in out], *([getattr(f, c) for _, f in out]
                                             for c in ("license", "start", "end", "words", "saved", "differences"))]
            types = [b.schema.field("doc_id").type, pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names=["doc_id", "license", "start", "end", "words", "saved", "differences"])

    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    # Texts without any cue word stop here, before Python.
    source = source.where(F.col("text").rlike("(?iu)" + "|".join(CUES)))
    return source.mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, {FINDING}")
