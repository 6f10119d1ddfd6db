import textwrap

import pytest

from vintage_panel.llm.license_texts import TEMPLATES
from vintage_panel.llm.licenses import _own_runs, _shared_runs, fit_scan, scan_licenses


@pytest.fixture(scope="module")
def docs(table, edge_rows):
    rows = [(2000 + i, f"some prose {i}\n{t.upper() if i % 2 else t}\nmore", "en", "a")
            for i, t in enumerate(x for ts in TEMPLATES.values() for x in ts)]
    rows += [(3000 + i, f"the license of the driver number {i} was taken\nall rights are {i} wrong", "en", "a") for i in range(40)]
    return table(rows + edge_rows)


def test_families_are_found_and_others_left(docs):
    got = {}
    for r in scan_licenses(docs, *fit_scan(docs)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == docs.count()
    names = [n for n, ts in TEMPLATES.items() for _ in ts]
    found = [got[2000 + i][0]["families"] for i in range(len(names))]
    assert sum(a == b for a, b in zip(found, names, strict=True)) >= 0.9 * len(names)
    others = [r for i, rs in got.items() if i is None or not 2000 <= i < 3000 for r in rs]
    assert all(r["families"] == "" and r["best_probability"] is None for r in others)


def test_empty(docs, empty):
    assert scan_licenses(empty, *fit_scan(docs)).collect() == []


NOTICES = {
    "All rights reserved.": "Proprietary",
    "Copyright (c) 2019 Northern Press Ltd. All rights reserved.": "Proprietary",
    "# MIT License": "MIT",
    "License: MIT License": "MIT",
    "Apache License 2.0": "Apache-2.0",
    "GNU GENERAL PUBLIC LICENSE": "GPL",
    "## BSD 3-Clause License": "BSD",
    "Mozilla Public License Version 2.0": "MPL-2.0",
}


def test_bare_notices_are_found(docs, table):
    noted = table([(5000 + i, f"some prose {i}\n{t}\nmore", "en", "a") for i, t in enumerate(NOTICES)])
    got = {r["doc_id"]: r["families"] for r in scan_licenses(noted, *fit_scan(docs)).collect()}
    assert {t: got[5000 + i] for i, t in enumerate(NOTICES)} == NOTICES


OTHERS = {  # not made from the templates
    "This library is under the GNU Lesser General Public License v2.1": "LGPL",
    "GNU Lesser General Public License": "LGPL",
    "GNU Affero General Public License version 3": "AGPL",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.": "CC-BY-ND",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.": "CC-BY-NC-SA",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 License.": "CC-BY-NC-ND",
    "This program comes under the GNU General Public License, version 3.": "GPL",
}


def test_relatives_are_told_by_a_word(docs, table):
    noted = table([(5500 + i, f"some prose {i}\n{t}\nmore", "en", "a") for i, t in enumerate(OTHERS)])
    got = {r["doc_id"]: r["families"] for r in scan_licenses(noted, *fit_scan(docs)).collect()}
    found = {t: got[5500 + i] for i, t in enumerate(OTHERS)}
    # a notice that is not found permits nothing; one that is found must be right
    assert {t: x for t, x in found.items() if x} == {t: OTHERS[t] for t, x in found.items() if x}
    assert sum(map(bool, found.values())) >= 6


def test_wrapped_templates_are_found(docs, table):
    cases = [(name, t) for name, ts in TEMPLATES.items() for t in ts if len(t) > 72]
    rows = [(6000 + i, "int main of prose\n" + "\n".join(f" * {x}" for x in textwrap.wrap(t, 72)) + f"\nsome code {i}", "en", "a")
            for i, (_, t) in enumerate(cases)]
    # wrapped texts stand in the corpus that the scan learns from
    corpus = docs.unionByName(table(rows))
    got = {r["doc_id"]: r for r in scan_licenses(corpus, *fit_scan(corpus)).collect()}
    found = [got[6000 + i] for i in range(len(cases))]
    assert [r["families"] for r in found] == [name for name, _ in cases]
    assert [r["n_paragraphs"] for r in found] == [2 + len(textwrap.wrap(t, 72)) for _, t in cases]
    assert all(0 < r["n_licensed"] <= r["n_paragraphs"] - 2 for r in found)


def test_texts_are_made_only_of_words_that_begin_a_run():
    sql = _shared_runs()
    for runs in (_own_runs(t)[1] for ts in TEMPLATES.values() for t in ts):
        assert all(f"'{run.split()[0]}'" in sql for run in runs)
    assert sql.count("if(x in (") == 2
