"""Small tables with every awkward row, and plain versions of what the operators compute."""

import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def documents(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "src", len(t or "")) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def sentence(n, seed=0):
    """n words that repeat in no two places."""
    return " ".join(f"w{seed}x{i}" for i in range(n))


AWKWARD = [
    None,
    "",
    "   \n\t ",
    "one",
    "two words",
    "Three Words here",
    sentence(40, 1),
    sentence(40, 1),
    sentence(30_000, 2),
    "é漢字 \U0001f600 ▁   x",
    "a" * 50_000,
    "Mail bob@example.com or +1 (555) 123-4567.\nThen 10.0.0.1 and 4111 1111 1111 1111",
]
AWKWARD_IDS = [0, 1, 2, 3, 4, 5, 6, 6, 8, 9, None, 11]


def shingles(text, width=3):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) >= width:
        return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
    return {tuple(words)} if words else set()


def component_rows(rows, percent=90, width=3):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows, by comparing all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    above = list(range(len(rows)))

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= percent * len(sets[i] | sets[j]):
                above[top(i)] = top(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(doc)
    smallest = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return [(doc, len(sets[i]), smallest[top(i)]) for i, (doc, _) in enumerate(rows)]


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def private_spans(text):
    """Base matches by the patterns as they are written."""
    text, found = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words, seen, copies = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    repeated = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(repeated)
