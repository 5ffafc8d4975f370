"""What the contracts say, in plain Python over lists of rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\f\r"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def low(id_):
    return (id_ is not None, id_)


def exact(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max(ids, key=low)
        out += [(i, keep, len(ids), i == keep, sha(text)) for i in ids]
    return out


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII))


def contamination(docs, items):
    windows = defaultdict(set)
    for item_id, text in items:
        words = tokens(text)
        for k in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[k : k + 10])].add(item_id)
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words, hit, found = tokens(text), set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                got = windows.get(tuple(words[k : k + size]))
                if got:
                    hit.update(range(k, k + size))
                    found |= got
        names = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(words), len(hit), len(names), sha(",".join(names)), bool(hit)))
    return out


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, span):
    digits = re.sub("[^0-9]", "", span)
    if kind == "ip":
        return all(int(p) <= 255 for p in span.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in KINDS.items()
        for m in re.finditer(pattern, text or "")
        if _valid(kind, m[0])
    ]


def personal(docs):
    out = []
    for doc_id, text in docs:
        spans = base_spans(text)
        counts = [sum(s[0] == kind for s in spans) for kind in KINDS]
        out.append((doc_id, *counts, sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))))
    return out


def chats(rows):
    groups = defaultdict(list)
    for conv_id, turn, role, text in rows:
        groups[conv_id].append(((turn is not None, turn), role or "", text or ""))
    out = []
    for conv_id, turns in groups.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out.append((conv_id, len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss)))
    return out


def line_dedup(docs):
    def key(line):
        return line.strip(BLANKS).translate(ASCII)

    holders = defaultdict(list)
    for doc_id, text in docs:
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= 20:
                holders[k].append(doc_id)
    keeper = {k: max(ids, key=low) for k, ids in holders.items() if len(ids) >= 3}
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def urls(pages):
    out = []
    for page_id, url in pages:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(ASCII)
        fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
        out.append((page_id, host, path, best and best[1] + best[2], best and best[0]))
    return out


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    if not words:
        return set()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def near(docs):
    """Every pair with a common shingle is compared."""
    sets = [shingles(text) for _, text in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    shared = defaultdict(int)
    for ks in holders.values():
        for i, a in enumerate(ks):
            for b in ks[i + 1 :]:
                shared[a, b] += 1
    for (a, b), both in shared.items():
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            parent[root(a)] = root(b)
    smallest = {}
    for k, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            r = root(k)
            smallest[r] = min(smallest.get(r, doc_id), doc_id)
    out = []
    for k, (doc_id, _) in enumerate(docs):
        own = smallest.get(root(k)) if sets[k] else doc_id
        out.append((doc_id, len(sets[k]), own, doc_id == own))
    return out


def crc(text: str | None) -> int:
    return zlib.crc32((text or "").encode())
