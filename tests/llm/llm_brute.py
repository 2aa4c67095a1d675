"""Plain Python versions of the operators, and a fixture of awkward documents."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

SPACE = " \t\n\r\x0b\f"

WORDS = ("able baker coal delta echo fable grain hotel iris joker karma lemon motor nylon ocean piano quilt "
         "river sugar tango umbra vapor whale xenon yacht zebra").split()


def awkward_documents(seed: int = 7, n: int = 60) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, size, key, a, row): nulls anywhere, copies, ties, clashing names."""
    r = random.Random(seed)
    line = lambda k: " ".join(r.choice(WORDS) for _ in range(k)).capitalize() + "."
    shared = [line(60), line(55)]
    texts = []
    for _ in range(n):
        lines = [line(r.randint(3, 30)) for _ in range(r.randint(1, 6))]
        if r.random() < 0.4:
            lines.insert(r.randint(0, len(lines)), r.choice(shared))
        texts.append("\n".join(lines))
    texts += texts[:5] + [texts[7] + " tail", "", "", " \n\t ", "%%% 123", "é" * 300, "Zü " * 400, "word", "two words"]
    texts += ["\n".join(line(20) for _ in range(300))]
    rows = [(i, t, r.choice(["en", "de", None]), r.choice(["s1", "s2", "s3", "s9", None]), len(t), 1, "k", 2, None)
            for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, texts[3], "en", "s1", 1, None, None, None, None),
             (None, None, None, None, None, None, None, None, None), (900, None, "de", "s2", 0, 1, "k", 2, "x"),
             (900, texts[11], "de", "s2", 0, 1, "k", 2, "x"), (-5, texts[12], "en", "s1", 3, 1, "k", 2, "x")]
    return rows


SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size int, `key` string, a long, `row` string")


def line_runs(lines: list[str], min_words: int, min_lines: int):
    """All runs of lines worth deleting, of any length: (start, end)."""
    for i in range(len(lines)):
        words = 0
        for j in range(i, len(lines)):
            words += len(lines[j].split())
            if words >= min_words or j - i + 1 >= min_lines:
                yield i, j + 1


def dedup_lines(texts: list[str | None], min_words: int = 50, min_lines: int = 3) -> list[tuple[str | None, int]]:
    """Kept text and number of deleted lines of texts in their order: every line of a run that occurs earlier goes."""
    seen, out = set(), []
    for text in texts:
        split = [] if text is None else text.split("\n")
        at = [n for n, l in enumerate(split) if l.strip(SPACE)]
        lines = [split[n].strip(SPACE) for n in at]
        gone = set()
        for start, end in line_runs(lines, min_words, min_lines):
            run = tuple(lines[start:end])
            if run in seen:
                gone |= {at[n] for n in range(start, end)}
            seen.add(run)
        kept = None if text is None else "\n".join(l for n, l in enumerate(split) if n not in gone)
        out.append((kept, len(gone)))
    return out


def repeated_spans(texts: list[str | None], length: int) -> list[tuple]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        spans: list[list[int]] = []
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        kept, at = b"", 0
        for s, e in spans:
            kept, at = kept + b[at:s], e
        kept += b[at:]
        out.append((len(b), len(b) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return out


def fingerprint(text: str | None, shingle: int = 3) -> int:
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [words[i:i + shingle] for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def link_groups(values: list[int], max_bits: int = 3) -> list[int]:
    """For each value the place of the first value of its component."""
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def source_targets(sizes: dict, share: float = 1.5, cap: float = 2.0) -> dict:
    """Water filling by repeated rounds: sources above their cap are fixed there, the rest share on."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        full = {s for s in free if cap * sizes[s] <= unit * weight[s]}
        if not full:
            return out | {s: unit * weight[s] for s in free}
        for s in full:
            out[s] = cap * sizes[s]
            left -= out[s]
        free -= full
    return out


def n_words(text: str | None) -> int:
    return len((text or "").encode().split())


def check_pieces(pieces, ids_of, window: int = 1024):
    """Asserts that pieces of documents cover their ids once and sequences are gapless; returns the padding share.

    ``pieces``: (doc_id, start, length, crc, doc_tokens, sequence_id, offset); ``ids_of``: lists of ids by doc_id.
    Documents of one id and length are covered as often as there are of them, by pieces of any of them.
    """
    import zlib
    from array import array
    from collections import defaultdict

    sequences, documents = defaultdict(list), defaultdict(list)
    for doc, start, length, crc, total, sequence, offset in pieces:
        sequences[sequence].append((offset, length))
        documents[doc, total].append((start, length, crc))
    want = defaultdict(list)
    for doc, lists in ids_of.items():
        for ids in lists:
            want[doc, len(ids) + 1].append(array("I", [*ids, 0]))
    assert set(documents) == set(want)
    for key, found in documents.items():
        covered, bodies = Counter(), [memoryview(ids).cast("B") for ids in want[key]]
        for start, length, crc in found:
            assert 0 < length <= window and 0 <= start <= key[1] - length
            assert any(zlib.crc32(b[4 * start:4 * (start + length)]) == crc for b in bodies)
            covered.update(range(start, start + length))
        assert covered == Counter({i: len(bodies) for i in range(key[1])})
    padding = used = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window
        used += end
        padding += window - end if end & (end - 1) else 0
    return padding / max(1, padding + used)
