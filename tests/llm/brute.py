"""Plain, slow statements of what the operators return."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")


def shingles(text, k=5):
    w = SPACED.findall(low(text))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


class Sets:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def near_groups(docs):
    """op5: docs [(id, text)]"""
    s = {i: shingles(t) for i, t in docs}
    inverted = collections.defaultdict(list)
    for i in s:
        for x in s[i]:
            inverted[x].append(i)
    shared = collections.Counter()
    for ids in inverted.values():
        ids = sorted(ids)
        for a in range(len(ids)):
            for b in range(a):
                shared[ids[b], ids[a]] += 1
    sets = Sets(s)
    for (a, b), c in shared.items():
        if 100 * c >= 75 * (len(s[a]) + len(s[b]) - c):
            sets.join(a, b)
    return sorted((i, len(s[i]), sets.find(i), sets.find(i) == i) for i in s)


def repeats(docs, window=100):
    """op1: docs in key order"""
    seen, out = set(), []
    for d, t in docs:
        b = (t or "").encode()
        edge = np.zeros(len(b) + 1, np.int64)
        for p in range(len(b) - window + 1):
            if b[p:p + window] in seen:
                edge[p] += 1
                edge[p + window] -= 1
            else:
                seen.add(b[p:p + window])
        gone = np.cumsum(edge)[:-1] > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone]) if b else b""
        out.append((d, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def contamination(docs, items):
    """op3"""
    windows = collections.defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(low(t))
        n = min(10, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[p:p + n])].add(str(i))
    sizes = {len(k) for k in windows}
    out = []
    for d, t in docs:
        w = ALNUM.findall(low(t))
        hit, found = [0] * len(w), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in windows:
                    found |= windows[tuple(w[p:p + n])]
                    hit[p:p + n] = [1] * n
        out.append((d, len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), sum(hit) > 0))
    return sorted(out)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        nxt = [i]
        for j in range(1, len(b) + 1):
            nxt.append(min(row[j] + 1, nxt[-1] + 1, row[j - 1] + (a[i - 1] != b[j - 1])))
        row = nxt
    return row[-1]


def line_groups(docs, blocks, similar=0.75):
    """op8: the SimHash blocks of a normal form are given, all else is stated
    anew: forms that share a block and are alike are linked."""
    def normal(s):
        return tuple(ALNUM.findall(low(s)))
    forms = collections.defaultdict(list)
    for d, t in sorted(docs):
        for n, s in enumerate(t.split("\n") if t else []):
            if normal(s):
                forms[normal(s)].append((d, n))
    keys = list(forms)
    hashes = np.array([blocks(" ".join(f)) for f in keys])
    sets = Sets(range(len(keys)))
    for i in range(len(keys)):
        for j in (np.flatnonzero((hashes[i + 1:] == hashes[i]).any(axis=1)) + i + 1).tolist():
            if distance(keys[i], keys[j]) <= (1 - similar) * max(len(keys[i]), len(keys[j])):
                sets.join(i, j)
    groups = collections.defaultdict(list)
    for i, f in enumerate(keys):
        groups[sets.find(i)] += forms[f]
    gone = collections.defaultdict(set)
    for places in groups.values():
        for d, n in sorted(places)[1:]:
            gone[d].add(n)
    out = []
    for d, t in docs:
        lines = t.split("\n") if t else []
        left = "\n".join(s for n, s in enumerate(lines) if n not in gone[d])
        out.append((d, len(lines), len(gone[d]), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out)


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, k=10):
    """op11: (item, rank, doc, score)"""
    tf = {d: collections.Counter(TERM.findall(low(t))) for d, t in docs}
    sizes = {d: sum(c.values()) for d, c in tf.items() if c}
    total = sum(sizes.values())
    df = collections.Counter(w for c in tf.values() for w in c)
    out = []
    for i, text in items:
        scores = collections.Counter()
        for term in TERM.findall(low(text)):
            for d, n in sizes.items():
                if term in tf[d]:
                    w = math.floor(1000 * math.log((2 * len(sizes) + 2) / (2 * df[term] + 1)))
                    m = 100 - 75 + (75 * n * len(sizes)) // total
                    scores[d] += w * ((1000000000 * tf[d][term]) // (1000 * tf[d][term] + 8 * m))
        best = sorted((-s, d) for d, s in scores.items() if s > 0)[:k]
        out += [(i, r + 1, d, -s) for r, (s, d) in enumerate(best)]
    return sorted(out, key=str)


def misspelled(docs, damage=97):
    """op12's words: {word: n}"""
    n = collections.Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = low(run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % damage == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(n):
    """op12: (word, form, root, n, n_near, form_n) of {word: n}"""
    form, near = {}, {}
    for a in n:
        own = [b for b in n if abs(len(a) - len(b)) < 2 and one_edit(a, b)]
        near[a] = len(own)
        best = min(own, key=lambda b: (-n[b], b), default=None)
        form[a] = best if own and n[best] >= 2 * n[a] else None
    out = []
    for a in n:
        root = a
        while form[root]:
            root = form[root]
        out.append((a, form[a], root, n[a], near[a], n[form[a]] if form[a] else None))
    return sorted(out, key=str)


def split_url(url):
    """op13: (host, path)"""
    if not url or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return low(host), re.split("[?#]", rest[len(host):], maxsplit=1)[0]


def best_rule(host, path, rules):
    fits = []
    for r, verdict in rules:
        h, _, p = r.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(r), len(h), r, verdict))
    return max(fits)[2:] if fits else (None, None)


def probable_split(name, counts, longest=24):
    """All splits of a short name: the most probable, then the fewest words."""
    total = sum(counts.values())

    def cost(w):
        return math.log(counts[w] / total) if counts.get(w) else -math.log(total) - len(w) * math.log(10)
    best = None
    for mask in range(1 << (len(name) - 1)):
        words, last = [], 0
        for i in range(1, len(name)):
            if mask >> (i - 1) & 1:
                words.append(name[last:i])
                last = i
        words.append(name[last:])
        if max(map(len, words)) <= longest:
            this = (round(sum(map(cost, words)), 9), -len(words))
            if best is None or this > best[0]:
                best = (this, words)
    return best[0]


def judged(pages, rules, seeds, counts, split, smoothing=1000.0):
    """op13: (page_id, host, path, rule, verdict); the splits are given."""
    def names(s):
        return re.findall(r"[^\W\d_]{1,256}|0", re.sub("[0-9]+", "0", s.lower()))

    def words(host, path):
        return [("host", w) for x in names(host) for w in split[x]] + [("path", w) for x in names(path) for w in split[x]]
    rows, block, allow, every = [], collections.Counter(), collections.Counter(), collections.Counter()
    n = [0, 0]
    for i, url, _ in pages:
        host, path = split_url(url)
        rule, says = best_rule(host, path, rules)
        own = words(host, path)
        rows.append((i, host, path, rule, says, own))
        every.update(own)
        if any(k == "host" and w in seeds for k, w in own):
            block.update(own)
            n[0] += 1
        elif says != "block":
            allow.update(own)
            n[1] += 1
    b, a, e = (sum(c.values()) for c in (block, allow, every))

    def score(own):
        odds = math.log((n[0] + 1) / (n[1] + 1))
        for w in own:
            share = smoothing * every[w] / e
            odds += math.log((block[w] + share) / (b + smoothing)) - math.log((allow[w] + share) / (a + smoothing))
        return odds
    return sorted([(i, host, path, rule, says or ("block" if n[0] and score(own) > 0 else "allow")) for i, host, path, rule, says, own in rows], key=str)


# op2: word vectors and pooling, word by word

_ALL = (1 << 64) - 1


def mixed(h):
    h &= _ALL
    h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & _ALL
    h = (h ^ h >> 27) * 0x94D049BB133111EB & _ALL
    return h ^ h >> 31


def hashed(data):
    raw = sum((x + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, x in enumerate(data))
    return mixed(raw + len(data) * 0xD6E8FEB86659FD93)


def index_vector(h, dim=64, nonzero=6):
    out = np.zeros(dim)
    for j in range(nonzero):
        x = mixed(h + (j + 1) * 0x9E3779B97F4A7C15)
        out[(x >> 8) % dim] += 1 if x & 1 else -1
    return out


def word_parts(word):
    """(hash of the word in lower case, vector of that, vector of its form)"""
    def kind(x):
        if x >= 0x80 or 97 <= x <= 122:
            return 1
        return 2 if 65 <= x <= 90 else 3 if 48 <= x <= 57 else x
    raw = word.encode()
    kinds = [kind(x) for x in raw]
    shape = [k for i, k in enumerate(kinds) if k > 3 or i == 0 or kinds[i - 1] != k]
    last = max([i for i, k in enumerate(kinds) if k <= 3], default=-1)
    bare = hashed(low(word).encode())
    form = index_vector(hashed(shape) ^ 0x5851F42D4C957F2D) + index_vector(hashed(kinds[last + 1:]) ^ 0x14057B7EF767814F)
    return bare, index_vector(bare), form


def contexts(texts, buckets):
    """Sums of the vectors of the words beside each word, by its bucket."""
    out = np.zeros((buckets, 64))
    for t in texts:
        words = [word_parts(w) for w in SPACED.findall(t or "")]
        for a, b in zip(words, words[1:]):
            out[mixed(a[0]) % buckets] += b[1] + b[2]
            out[mixed(b[0]) % buckets] += a[1] + a[2]
    return out


def pooled(text, context):
    words = [word_parts(w) for w in SPACED.findall(text or "")]
    n = len(words)
    own = sum([w[1] for w in words], np.zeros(64)) / max(n, 1)
    form = sum([w[2] + context[mixed(w[0]) % len(context)] for w in words], np.zeros(64)) / max(n, 1)
    again = sum(a[0] == b[0] for a, b in zip(words, words[1:])) / max(n - 1, 1)
    return np.concatenate([own, form, [np.sqrt((own ** 2).sum()), np.sqrt((form ** 2).sum()), again, np.log1p(n) / 5]])
