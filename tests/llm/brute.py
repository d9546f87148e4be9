"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from html.parser import HTMLParser

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def repeats(rows, window=20):
    """doc_id -> (words, removed, digest of what is kept)."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[doc] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def shingles(text, k=4):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def classes(rows, percent=85, k=4):
    """doc_id -> (set size, smallest linked id)."""
    sets = {d: shingles(t, k) for d, t in rows}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    common = Counter()
    for held in holders.values():
        for i, a in enumerate(held):
            for b in held[:i]:
                common[min(a, b), max(a, b)] += 1
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


def ppm(train, texts, order):
    """log10 probability of each byte string, by PPM with method C and exclusion."""
    counts = defaultdict(Counter)
    for t in train:
        b = b"\n" * order + t + b"\n"
        for i in range(order, len(b)):
            for k in range(order + 1):
                counts[b[i - k : i]][b[i]] += 1
    out = []
    for t in texts:
        b, total = b"\n" * order + t + b"\n", 0.0
        for i in range(order, len(b)):
            gone, coded = set(), False
            for k in range(order, -1, -1):
                here = counts.get(b[i - k : i])
                if not here:
                    continue
                left = {s: n for s, n in here.items() if s not in gone}
                n, kinds = sum(left.values()), len(left)
                if b[i] in left:
                    total += math.log10(left[b[i]] / (n + kinds))
                    coded = True
                    break
                if kinds:
                    total += math.log10(kinds / (n + kinds))
                gone |= set(here)
            if not coded:
                total -= math.log10(256 - len(gone))
        out.append(total)
    return out


def grey_feature(payload, row=64):
    """Statistics of the samples, one by one."""
    n, counts = len(payload), Counter(payload)
    mean = sum(payload) / n
    dev = math.sqrt(sum((x - mean) ** 2 for x in payload) / n)
    bits = -sum(c / n * math.log2(c / n) for c in counts.values())
    steps = [abs(payload[i + row] - payload[i]) for i in range(n - row)]
    change = sum(steps) / len(steps) if steps else 0.0
    return f"mean={mean:.4f};dev={dev:.4f};bits={bits + 0.0:.4f};levels={len(counts)};change={change:.4f}"


class _Lines(HTMLParser):
    """Lines of a page without articles, each with whether an advert, comment or side element is around it."""

    def __init__(self):
        super().__init__()
        self.lines, self.text, self.marks = [], [], []

    def end_line(self):
        said = " ".join("".join(self.text).split())
        if said:
            self.lines.append((said, any(self.marks)))
        self.text = []

    def handle_starttag(self, tag, attrs):
        self.end_line()
        if tag in ("div", "ul"):
            self.marks.append(dict(attrs).get("class") in ("ad", "ad-slot", "user-comments", "sidebar"))
        self.skip = tag == "title"

    def handle_endtag(self, tag):
        self.end_line()
        if tag in ("div", "ul"):
            self.marks.pop()
        self.skip = False

    def handle_data(self, data):
        if not self.skip:
            self.text.append(data)


def main_texts(pages):
    """page_id -> text: lines that the page of the host with the nearest path doesn't share in order."""
    parsed = {}
    for page, _, html in pages:
        p = _Lines()
        p.feed(html)
        p.end_line()
        parsed[page] = p.lines
    out = {}
    for page, url, _ in pages:
        host, path = re.match(r"http://([^/]*)(.*)", url).groups()
        best = None
        before = [(u, p) for p, u, _ in pages if u.startswith(f"http://{host}/") and u < url]
        after = [(u, p) for p, u, _ in pages if u.startswith(f"http://{host}/") and u > url]
        for u, p in ([max(before)] if before else []) + ([min(after)] if after else []):
            other = re.match(r"http://[^/]*(.*)", u)[1]
            near = next((i for i, (x, y) in enumerate(zip(path, other)) if x != y), min(len(path), len(other)))
            if best is None or near > best[0]:
                best = (near, p)
        a, b = [t for t, _ in parsed[page]], [t for t, _ in parsed[best[1]]] if best else []
        length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                length[i][j] = length[i + 1][j + 1] + 1 if a[i] == b[j] else max(length[i + 1][j], length[i][j + 1])
        shared, i, j = set(), 0, 0
        while i < len(a) and j < len(b):
            if a[i] == b[j]:
                shared.add(i)
                i, j = i + 1, j + 1
            elif length[i + 1][j] >= length[i][j + 1]:
                i += 1
            else:
                j += 1
        if len(shared) == len(a):
            shared = set()
        out[page] = " ".join(t for k, (t, frame) in enumerate(parsed[page]) if k not in shared and not frame)
    return out


def main_lines(tree):
    """Main text of a tree of (element, children) and lines, alone on its host."""

    def lines(nodes, path):
        for n in nodes:
            if isinstance(n, str):
                yield n, path
            else:
                yield from lines(n[1], (*path, n))

    every = list(lines(tree, ()))
    is_main = lambda n: n[0] in ("article", "main")

    def place(path):
        mains = [i for i, n in enumerate(path) if is_main(n)]
        start = mains[0] if mains else 0

        def frame(i):
            kind, inside = path[i][0], bool(mains) and i > start
            return kind in ("aside", "nav", "div class=share", "div class=sidebar") or kind == "div class=user-comments" and not inside

        around, within = (any(map(frame, r)) for r in (range(start), range(start, len(path))))
        if mains:
            return "frame" if within else "framed" if around else "article"
        return "frame" if within else "open"

    out = []
    for said, path in every:
        start = next((i for i, n in enumerate(path) if is_main(n)), 0)
        form = next((n for n in path[start:] if n[0] == "form"), None)
        here = place(path)
        if form is not None and here != "frame":
            inside = lambda p: any(n is form for n in p[next((i for i, n in enumerate(p) if is_main(n)), 0) :])
            held = [t for t, p in every if inside(p) and place(p) != "frame"]
            if all(len(t.split()) < 20 for t in held):
                here = "frame"
        out.append((said, here))
    for wanted in ("article", "framed", "open"):
        if any(h == wanted for _, h in out):
            return [t for t, h in out if h == wanted]
    return []


def mix_targets(sizes, most=3):
    """source -> target; sizes in code-point order with null last."""
    names = list(sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, rest = {}, set(names), sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / total > most * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = most * sizes[s]
            free.discard(s)
        rest = sum(sizes.values()) - sum(target.values())
    for s in free:
        target[s] = rest * weight[s] / sum(weight[x] for x in free)
    return target


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())
