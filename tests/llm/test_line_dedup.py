import random

from vintage_panel.llm.line_dedup import line_dedup

SPACES = " \t\n\x0b\x0c\r"


def brute(rows):
    """Documents in order of id (NULL first), then text; equal ids and texts are one."""
    seen, gone = set(), {}
    parts = {}
    for i, t, *_ in rows:
        parts[i, t or ""] = [x.replace("\r", "").strip(" ") for x in (t or "").split("\n") if x.strip(SPACES)]
    for key in sorted(parts, key=lambda k: (k[0] is not None, k[0] or 0, k[1])):
        lines, covered = parts[key], set()
        for p in range(len(lines) - 2):
            window = tuple(lines[p : p + 3])
            if window in seen:
                covered |= {p, p + 1, p + 2}
            seen.add(window)
        gone[key] = covered
    out = []
    for i, t, *_ in rows:
        covered, kept, place = gone[i, t or ""], [], 0
        for line in (t or "").split("\n"):
            full = bool(line.strip(SPACES))
            if not (full and place in covered):
                kept.append(line)
            place += full
        out.append((i, None if t is None else "\n".join(kept), place, len(covered)))
    return sorted(out, key=str)


def test_windows_equal_brute_force(table, edge_rows):
    rng = random.Random(4)
    lines = [f"line {k}" for k in range(30)]
    rows = []
    for i in range(60):
        at = rng.randrange(20)
        own = [f"own {i} {k}" for k in range(rng.randrange(5))]
        rows.append((i + 1000, "\n".join(own + lines[at : at + rng.randrange(9)] + ["", "  "] + own), "en", "a"))
    rows += [(2000, "a\na\na\na\na\n", "en", "a"), (2001, "x\n\ny\nz", "en", "a"), (2002, " x\r\ny \r\n\n z", "en", "a")]
    got = line_dedup(table(rows + edge_rows)).select("row.doc_id", "kept_text", "n_lines", "n_removed").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows + edge_rows)


def test_empty(empty):
    assert line_dedup(empty).collect() == []
