"""Plain single-machine versions of the operators, for comparison on small tables."""

import hashlib
import re
from collections import Counter, defaultdict

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def components(docs, percent=75):
    """doc_id -> (set size, smallest reachable id)."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def contamination(docs, items, window=10):
    wins = defaultdict(set)
    for i, t in items:
        w = WORDS.findall((t or "").encode().lower())
        k = min(window, len(w))
        for j in range(len(w) - k + 1 if w else 0):
            wins[tuple(w[j : j + k])].add(i)
    sizes = {len(k) for k in wins}
    out = {}
    for i, t in docs:
        w, hit, found = WORDS.findall((t or "").encode().lower()), set(), set()
        for k in sizes:
            for j in range(len(w) - k + 1):
                if tuple(w[j : j + k]) in wins:
                    hit.update(range(j, j + k))
                    found |= wins[tuple(w[j : j + k])]
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit))
    return out


def line_dedup(docs):
    seen, count = {}, Counter()
    texts = [(i, t.split("\n")) for i, t in sorted(docs) if t is not None]
    keys = lambda l: [(j, tuple(l[j : j + 3])) for j in range(len(l) - 2) if "".join(l[j : j + 3]).strip(" \t\n\r\x0b\x0c")]  # noqa: E731, E741
    for i, lines in texts:
        for j, k in keys(lines):
            seen.setdefault(k, (i, j))
            count[k] += 1
    out = {}
    for i, lines in texts:
        late, first = set(), set()
        for j, k in keys(lines):
            if count[k] > 1:
                (first if seen[k] == (i, j) else late).update(range(j, j + 3))
        gone = late - first
        out[i] = (len(lines), len(gone), "\n".join(x for j, x in enumerate(lines) if j not in gone))
    return out


def statistics(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if wins[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def filter_audit(docs, labels):
    """Rows of the filter audit, by applying every order to every document."""
    from itertools import permutations

    first, fails = {}, {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    rows = []
    for i, t, part in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first.get(t, i),
        }
        good, toxic = (any(x[0] == i and x[k] == 1 for x in labels) if i is not None else False for k in (1, 2))
        rows.append((part or "", {f for f, x in failed.items() if x}, good, toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        total = Counter()
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                all_failing = [r for r in mine if f in r[1]]
                left = [r for r in left if f not in r[1]]
                total[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), len(all_failing) - len(gone), sum(r[1] == {f} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {(*k, *v) for k, v in out.items()}


def fill_in_middle(doc_id, text):
    """(n, form, prefix characters, middle characters, output)."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def base_spans(text):
    """(start, end, kind) of the fixed secret patterns, found character by character."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    value = set(letters + letters.upper() + "0123456789+/_.=-")

    def run(at, chars):
        while at < len(text) and text[at] in chars:
            at += 1
        return at

    def assign(at):
        """Ends of the name, of the value, and where the value starts; None if nothing matches here."""
        for name in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text[at : at + len(name)]) != name:
                continue
            k = at + len(name)
            k = run(k + (text[k : k + 1] in ("'", '"')), " ")
            if text[k : k + 1] not in (":", "="):
                continue
            k = run(k + 1, " ")
            k += text[k : k + 1] in ("'", '"')
            if run(k, value) > k:
                return run(k, value), run(k, value) - k
        return None

    out, at = [], 0
    while at < len(text):
        found = assign(at)
        if found and found[1] >= 6:
            out.append((at, found[0], "assign"))
        at = found[0] if found else at + 1
    at = 0
    while at < len(text):
        end = run(at + 4, set(letters.upper() + "0123456789")) if text[at : at + 4] == "AKIA" else at
        if end > at + 4:
            if end - at >= 20:
                out.append((at, end, "access"))
            at = end
        else:
            at += 1
    at = 0
    while at < len(text):
        end = run(at, set("0123456789abcdef"))
        if end - at >= 24:
            out.append((at, end, "hex"))
        at = max(end, at + 1)
    return sorted(out, key=lambda s: (s[0], ("assign", "access", "hex").index(s[2])))
