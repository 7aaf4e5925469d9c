"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re


def line_key(line: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\r\x0b\x0c"))


def dedup_lines(docs: list[tuple], min_chars: int = 10) -> list[tuple]:
    """(id, text) -> (id, n_lines, n_dropped, kept) in the same order."""
    keeper, seen = {}, {}
    for doc, text in docs:
        if doc is None:
            continue
        for line in (text or "").split("\n"):
            k = line_key(line)
            if len(k) >= min_chars:
                seen.setdefault(k, set()).add(doc)
                keeper[k] = min(keeper.get(k, doc), doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or not (
            len(line_key(x)) >= min_chars and len(seen[line_key(x)]) > 1 and keeper[line_key(x)] != doc)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingles(text: str | None, size: int) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    n = min(size, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def components(nodes, links) -> dict:
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def jaccard_components(docs: list[tuple], size: int, part: int, of: int) -> dict:
    sets = {}
    for doc, text in docs:
        if doc is not None:
            sets[doc] = shingles(text, size)
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if sets[a] and sets[b] and of * len(sets[a] & sets[b]) >= part * len(sets[a] | sets[b])]
    return components(ids, links)


def item_words(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def contamination(text: str | None, items: list[tuple], window: int = 13) -> tuple:
    """(n_words, hit positions, items that occur)."""
    words = item_words(text)
    hit, found = set(), set()
    for name, item in items:
        w = item_words(item)
        n = min(window, len(w))
        if not n:
            continue
        grams = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
        for i in range(len(words) - n + 1):
            if tuple(words[i:i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(str(name))
    return len(words), hit, found


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
