"""Plain versions of the operators, one document at a time."""
import hashlib
import re

import xxhash

WS = " \t\n\x0b\x0c\r"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def dedup_lines(docs):
    """{doc_id: (n_lines, n_dropped, text)} for distinct ids; docs: {doc_id: text}."""
    holders = {}
    for i, text in docs.items():
        for line in (text or "").split("\n"):
            key = low(line.strip(WS))
            if len(key) >= 20:
                holders.setdefault(key, set()).add(i)
    out = {}
    for i, text in docs.items():
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(h := holders.get(low(x.strip(WS)), ())) < 3 or max(h) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, linked):
    """{id: smallest id reachable} by comparing all pairs."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = list(ids)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def simhash_groups(docs):
    prints = {i: fingerprint(t) for i, t in docs.items()}
    return prints, groups(docs, lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 2)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def contamination(text, items, width=10):
    """(n_words, n_hit, item ids)."""
    own = words(text)
    hit, found = set(), set()
    for item, body in items:
        parts = words(body)
        size = min(width, len(parts))
        windows = {tuple(parts[i:i + size]) for i in range(len(parts) - size + 1)} if size else set()
        for at in range(len(own) - size + 1 if size else 0):
            if tuple(own[at:at + size]) in windows:
                hit |= set(range(at, at + size))
                found.add(str(item))
    return len(own), len(hit), sorted(found)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)
