"""Licences that are known by digest alone."""

import os
import textwrap

import pytest

from loadlens.llm import licence_texts, licences, shared

#: Where Linux systems keep the texts, and their names there.
FOLDER = "/usr/share/common-licenses"
FILES = {"Artistic-1.0-Perl": "Artistic", "GPL-1.0": "GPL-1", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.0": "LGPL-2", "LGPL-3.0": "LGPL-3"}


def test_digests_are_of_the_published_texts(spark, docs_of):
    texts = {}
    for name, _, _ in licence_texts.DIGESTS:
        path = f"{FOLDER}/{FILES.get(name, name)}"
        if os.path.exists(path):
            with open(path, encoding="utf-8") as file:
                texts[name] = file.read()
    if not texts:
        pytest.skip("no licence texts on this system")
    names = sorted(texts)
    # lines that may count as copyright lines, "(c)" items among them, are left as they are
    whole = lambda line: "COPYRIGHT" in line or "(C)" in line or "RIGHTS RESERVED" in line
    reflowed = lambda t: "\r\n".join(p if whole(p) else textwrap.fill(p, 50) for p in t.upper().split("\n"))
    rows = [(i, texts[n]) for i, n in enumerate(names)] + [(100 + i, reflowed(texts[n])) for i, n in enumerate(names)]
    rows += [(200 + i, texts[n] + "\nmore terms") for i, n in enumerate(names)]
    got = {r.doc_id: r.licence for r in licences.scan_licences(docs_of(rows)).collect()}
    assert [got[i] for i in range(len(names))] == names
    assert [got[100 + i] for i in range(len(names))] == names
    assert {got[200 + i] for i in range(len(names))} == {None}
    sizes = {r.licence: r.size for r in licences.known_digests(spark, list(texts.items())).collect()}
    assert sizes == {n: s for n, _, s in licence_texts.DIGESTS if n in texts}


def test_a_cluster_needs_a_shared_folder(spark):
    class Elsewhere:
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(Elsewhere)
