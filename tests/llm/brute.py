"""Plain single-process versions of the operators, to compare with on small tables."""

import hashlib
import math
import re
import struct
import zlib

import numpy as np
import xxhash

BLANKS = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(s):
    return s.translate({c: c + 32 for c in range(65, 91)})


def sha(s):
    return hashlib.sha256(s.encode() if isinstance(s, str) else s).hexdigest()


def roots(nodes, links):
    """Smallest node of each component."""
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def edited_texts(docs):
    """doc_id -> edited text; docs: {doc_id: text}"""
    ids = sorted(docs)
    out = {}
    for i, d in enumerate(ids):
        t, n = docs[d] or "", docs[ids[(i + 1) % len(ids)]] or ""
        cut = len(t) // 4
        out[d] = t[:len(t) - cut] + n[:cut]
    return out


def shingle_set(text, k=5):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text.lower()) if x]
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def line_dedup(docs):
    keys = {d: [(x, ascii_lower(x.strip(" \t\n\x0b\f\r"))) for x in (t or "").split("\n")] for d, t in docs.items()}
    first, holders = {}, {}
    for d, lines in keys.items():
        for _, k in lines:
            if len(k) >= 10:
                holders.setdefault(k, set()).add(d)
    out = {}
    for d, lines in keys.items():
        kept = [x for x, k in lines if not (len(k) >= 10 and len(holders[k]) > 1 and d != min(holders[k]))]
        out[d] = (len(lines), len(lines) - len(kept), sha("\n".join(kept)))
    return out


def vector_links(rows, least=0.98):
    """vec_id -> (n_links, component); rows: (vec_id, embedding, label)"""
    use = [(i, np.array(v, float), lab) for i, v, lab in rows
           if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n, links = {i: 0 for i, _, _ in rows}, []
    for a in range(len(use)):
        for b in range(a + 1, len(use)):
            (i, x, p), (j, y, q) = use[a], use[b]
            if p == q and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                n[i] += 1
                n[j] += 1
                links.append((i, j))
    comp = roots(list(n), links)
    return {i: (n[i], comp[i]) for i in n}


def chat_digests(turns):
    """(n_turns, turns_sha256, loss_chars, loss_sha256); turns: (role, text) in order"""
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)), len(loss), sha(loss)


def simhash(text, k=3):
    w = BLANKS.findall(ascii_lower(text or ""))
    if not w:
        return 0
    s = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def pack_ids(ids, capacity=4096):
    """Pieces of a document: (piece, start, length, crc)"""
    out = []
    for p, at in enumerate(range(0, len(ids), capacity)):
        cut = ids[at:at + capacity]
        out.append((p, at, len(cut), zlib.crc32(struct.pack(f"<{len(cut)}I", *cut))))
    return out


TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def fill_middle(doc_id, text, rate=50, spm=80, unit=TOKEN):
    """(n, form, prefix_chars, middle_chars, output) of one document."""
    text = text or ""
    units = unit.findall(text)
    h = [int(sha(f"42:{'' if doc_id is None else doc_id}")[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def lloyd(rows, parts=8, entries=16, rounds=6):
    """Rows (vec_id, code, error, label_error, digest), sorted as text; rows: (vec_id, vector, label), kept vectors of one length."""
    whole = lambda x: int(x) * 4096 if abs(x) >= 2**52 else math.floor(4096 * x)
    kept = [(i, [whole(x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max(1, -(-len(kept[0][1]) // parts))
    cut = [[tuple((v + [0] * width * parts)[p * width:(p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda j: (kept[j][0] is None, kept[j][0] or 0, [float(x) for x in kept[j][1]]))[:entries]
    book = [[cut[j][p] for j in first] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, b: min(range(len(b)), key=lambda e: (dist(x, b[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            of = [near(c[p], book[p]) for c in cut]
            for e in set(of):
                own = [c[p] for c, o in zip(cut, of) if o == e]
                book[p][e] = tuple(sum(x) // len(own) for x in zip(*own))
    codes = [[near(c[p], book[p]) for p in range(parts)] for c in cut]
    errors = [sum(dist(c[p], book[p][k[p]]) for p in range(parts)) for c, k in zip(cut, codes)]
    total = {}
    for (_, _, lab), e in zip(kept, errors):
        total[lab] = total.get(lab, 0) + e
    digest = sha(",".join(str(x) for b in book for e in b for x in e))
    long = lambda x: x if x < 2**63 else None
    return sorted(((i, "".join(f"{x:02x}" for x in k), long(e), long(total[lab]), digest) for (i, _, lab), k, e in zip(kept, codes, errors)), key=str)
