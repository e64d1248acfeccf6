from stintflow.llm import licences

from . import cases


def test_equivalent_texts(spark):
    known = dict((name, text) for name, text in licences.TEXTS if "\n" in text)
    rows = [(1, "Copyright (c) 2020 Me\n" + known["ISC"].replace(",", " ;").upper()), (2, "The MIT Licence (MIT)\n\n  (c) 2019 X\n" + licences._MIT), (3, "x\nReleased under the MIT Licence!\nLicensed under CC BY 4.0"),
            (4, None), (5, ""), (6, known["BSD-2-Clause"] + " and more")]
    got = {r.doc_id: (r.licence, r.notices) for r in licences.scan(cases.documents(spark, rows), licences.known(spark)).collect()}
    assert got == {1: ("ISC", ""), 2: ("MIT", ""), 3: (None, "CC-BY-4.0,MIT"), 4: (None, ""), 5: (None, ""), 6: (None, "")}


def test_canonical_in_python_and_spark_agree(spark):
    import hashlib
    docs = cases.documents(spark)
    for r, d in zip(docs.orderBy("doc_id").collect(), licences.scan(docs, licences.known(spark)).orderBy("doc_id").collect()):
        assert d.digest == hashlib.sha256(licences.canonical_text(r.text).encode()).hexdigest()
    assert licences.scan(cases.awkward(spark), licences.known(spark)).count() == 7
    assert licences.scan(cases.empty(spark), licences.known(spark)).collect() == []


ZLIB = """zlib License

(C) 2020 Somebody

This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.
"""


def test_whole_texts(spark):
    from pathlib import Path
    folder = Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0",
             "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "GFDL-1.3": "GFDL-1.3", "Artistic": "Artistic-1.0-Perl", "BSD": "BSD-3-Clause"}
    found = {file: (folder / file).read_text() for file in names if (folder / file).exists()}
    rows = [("Zlib", ZLIB), ("Zlib", ZLIB.partition("\n")[2].upper())] + [(names[file], text) for file, text in found.items()]
    rows += [(names[file], found[file].partition("END OF TERMS")[0].replace("\n", "  \n")) for file in ("Apache-2.0", "GPL-2", "GPL-3") if file in found]
    rows += [(None, text[:-200]) for text in found.values()]
    got = {r.doc_id: r.licence for r in licences.scan(cases.documents(spark, [(k, text) for k, (_, text) in enumerate(rows)]), licences.known(spark)).collect()}
    assert got == {k: name for k, (name, _) in enumerate(rows)}


def test_wrapping_does_not_matter():
    import textwrap
    known = licences.known_digests()
    for name, text in licences.TEXTS:
        for width in range(40, 121):
            wrapped = "\n".join(textwrap.fill(part, width, break_long_words=False) for part in text.split("\n"))
            joined = textwrap.fill(text.replace("\n", " "), width, initial_indent=" * ", subsequent_indent=" * ", break_long_words=False)
            for form in (wrapped, joined, wrapped.upper(), f"Copyright (c) 2020 The Authors\nAll rights reserved.\n\n{wrapped}"):
                assert known[licences.digest_of(form)][0] == name, (name, width)


def test_copyright_lines(spark):
    gone = ["Copyright (c) 2020 Me", "  # copyright 1999, 2001 by X", "(C) 2020 Somebody", "© Somebody", "Copyright The Foo Authors", "copyright by me", "COPYRIGHT (C) ME", "All rights reserved.", "Copyright: 2020 Me"]
    kept = ["copyright notice and this permission", "Copyright Holder means whoever", "COPYRIGHT HOLDERS BE LIABLE", "copyright", "(c) You must retain, in the Source form", "all rights reserved by the owner and others",
            "copyright law", "copyright resulting from their use", "Copyright License. Subject to the terms"]
    rows = [(k, f"before\n{line}\nbehind") for k, line in enumerate(gone + kept)]
    got = {r.doc_id: r.digest for r in licences.scan(cases.documents(spark, rows), licences.known(spark)).collect()}
    for k, line in rows:
        assert got[k] == licences.digest_of(line)
        assert (licences.canonical_text(line) == "before behind") == (k < len(gone)), line


def test_lines_that_may_be_notices(spark):
    rows = [(1, "x\n  * Licenced under CC BY 4.0"), (2, "(licensed under the mit licence)\nReleased under the BSD 2-Clause License."), (3, licences._MIT.replace("\n", " ") + "\nmore"), (4, "© Licensed under the MIT License.")]
    got = {r.doc_id: (r.licence, r.notices) for r in licences.scan(cases.documents(spark, rows), licences.known(spark)).collect()}
    assert got == {1: (None, "CC-BY-4.0"), 2: (None, "BSD-2-Clause,MIT"), 3: (None, "MIT"), 4: (None, "")}
    assert set(licences.beginnings(["license", "licensed"])) == {"license", "licensed", "licence", "licenced"}


def test_digests_are_those_of_the_texts_at_hand():
    from pathlib import Path
    from tests.llm.whole_licences import entries
    folder = Path("/usr/share/common-licenses")
    made = entries(sorted(f for f in folder.iterdir() if f.is_file())) if folder.exists() else []
    known = {digest: (name, first) for name, digest, first in licences.WHOLE_TEXTS}
    named = {licences.digest_of((folder / file).read_text()): name for file, name in (("Apache-2.0", "Apache-2.0"), ("GPL-3", "GPL-3.0"), ("MPL-2.0", "MPL-2.0")) if (folder / file).exists()}
    assert all(known[digest][0] == name for digest, name in named.items())
    assert all(known[digest] == (name, first) for name, digest, first in made if digest in known)
