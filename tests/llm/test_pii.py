import hashlib
import random
import re

from vintage_panel.llm.pii import KINDS, base_spans, emails, find_pii, reliabilities

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def brute(text):
    spans = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (
                kind == "email"
                or (kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")))
                or (kind == "card" and 14 <= len(digits) <= 19 and luhn(digits))
                or (kind == "phone" and 10 <= len(digits) <= 15)
            ):
                spans.append((kind, *m.span()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def test_base_spans_equal_the_patterns():
    rng = random.Random(6)
    for _ in range(4000):
        text = "".join(rng.choice("ab@.-_+% 012345()x") for _ in range(rng.randint(0, 60)))
        assert base_spans(text) == brute(text)
    for text in ("4111 1111 1111 1111", "+1 (523) 555-1055.", "1.2.3.4.5.6.7.8", "a@b.c@d.e", "a@b.c-x_y@d.e"):
        assert base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    assert base_spans("1" * 400_000) == [] and emails("a" * 400_000 + "@" * 10) == []
    assert base_spans("1." * 200_000)[0][0] == "ip"


def test_added_spans_leave_base_spans(table, edge_rows):
    known = [(i, f"call me: phone +1 (523) 555-{1000 + i} now, mail u{i}@mail.example.com", "en", "a") for i in range(60)]
    missed = [(500 + i, f"my phone 523 555-{2000 + i} please", "en", "a") for i in range(30)]
    plain = [(800 + i, f"in {1900 + i} they counted {i}.5 of 100 things", "en", "a") for i in range(60)]
    rows = known + missed + plain + edge_rows
    got = find_pii(table(rows)).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r)
    for i, text, *_ in rows:
        want = brute(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        digest = hashlib.sha256(joined.encode()).hexdigest()
        r = next(r for r in by_id[i] if r["base_sha256"] == digest)
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in want) for k in KINDS]
        assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))
    assert all(by_id[800 + i][0]["spans"] == "" for i in range(60))


def test_reliable_labelers_outvote_noise():
    rng, counts = random.Random(1), {}
    for _ in range(20_000):
        true = rng.random() < 0.3
        good = [("p" if true else "n") if rng.random() < 0.95 else ("n" if true else "p") for _ in range(3)]
        bad = [rng.choice("pn-") for _ in range(2)]
        counts["".join(good + bad)] = counts.get("".join(good + bad), 0) + 1
    post = reliabilities(sorted(counts.items()))
    assert post["pppnn"] > 0.9 and post["nnnpp"] < 0.1


def test_empty(empty):
    assert find_pii(empty).collect() == []
