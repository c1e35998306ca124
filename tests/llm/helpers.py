"""Small inputs with awkward rows, and plain models to compare with."""

import random

CLASH = "n long, score double, start int, ids string, spans string, label int, h1 long, grp long, first long"
CLASH_ROW = (1, 2.0, 3, "i", "s", 4, 5, 6, 7)
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


def docs_frame(spark, rows, clash=True):
    """Rows (doc_id, text) as documents, with extra columns whose names the operators use themselves."""
    full = [(i, t, "en", f"src{(i or 0) % 3}" if i != 2 else None, len(t or "")) + (CLASH_ROW if clash else ()) for i, t in rows]
    return spark.createDataFrame(full, DOCS + (", " + CLASH if clash else ""))


def sample_docs(seed=7):
    """(doc_id, text): plain texts, copies, near copies, null, empty, blank, short, very long, non-ASCII."""
    rng = random.Random(seed)
    rows = [(i, ". ".join(words(rng, rng.randint(3, 12)) for _ in range(rng.randint(1, 8))) + ".") for i in range(40)]
    for i in (3, 7, 11):
        rows.append((100 + i, rows[i][1]))  # copies
        t = rows[i][1].split()
        t[len(t) // 2] = "changed"
        rows.append((200 + i, " ".join(t)))  # near copies
    long = words(rng, 30_000, 5000)
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "one"), (304, "One"), (305, "a b c d"), (306, long),
             (307, long + " tail"), (308, "Ärger über Größe 漢字 😀 " * 20), (309, "x" * 50_000), (None, rows[0][1]),
             (310, rows[5][1]), (310, rows[5][1])]
    return rows


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
