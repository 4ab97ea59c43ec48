import hashlib
import os
import re
import sys

import pytest
import xxhash

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from sparkrank.session import local_session

    return local_session(8, shuffle_partitions=8, app="sparkrank-llm-tests")


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from ``(doc_id, text)`` pairs, with clashing extra columns."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, w string, h string, fp string, spans string, component long"
        return spark.createDataFrame([(i, t, None, None, len(t) if t else None, "x", "y", "z", "s", 1) for i, t in rows], schema)

    return make


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def contaminated_rows(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, named = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            for k in range(max(1, len(v) - 12) if v else 0):
                win = v[k : k + 13]
                for at in range(len(w) - len(win) + 1):
                    if w[at : at + len(win)] == win:
                        hit |= set(range(at, at + len(win)))
                        named.add("" if item_id is None else str(item_id))
        ids = sorted(named)
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def fingerprint(text, width=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, bits=3):
    """Component of each index by comparing all pairs."""
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


@pytest.fixture(scope="session")
def brute():
    """Brute-force decontamination rows, SimHash fingerprint and grouping."""
    return contaminated_rows, fingerprint, groups
