"""Makes ``WHOLE_TEXTS`` of the licence scan from public licence texts: ``python -m tests.llm.whole_licences FOLDER ...``.

Reads every file of the folders, names the licence by a phrase of its text, and prints name, digest and first word of the whole text, of the text
before its appendix, and of the text behind its title line.
"""
import re
import sys
from pathlib import Path

from stintflow.llm.licences import canonical_text, digest_of

# How each text begins once it is canonical, and its least and most words.
TITLES = (
    ("Apache-2.0", "apache license version 2 0 january 2004", 1000, 2200), ("Artistic-1.0-Perl", "the artistic license preamble", 500, 1500), ("BSL-1.0", "boost software license version 1 0", 150, 300),
    ("CC0-1.0", "creative commons legal code cc0 1 0 universal", 800, 1300), ("GFDL-1.2", "gnu free documentation license version 1 2", 2500, 4000), ("GFDL-1.3", "gnu free documentation license version 1 3", 2500, 4500),
    ("GPL-1.0", "gnu general public license version 1 february 1989", 1000, 2600), ("GPL-2.0", "gnu general public license version 2 june 1991", 2000, 3300), ("GPL-3.0", "gnu general public license version 3 29 june 2007", 4500, 6500),
    ("LGPL-2.0", "gnu library general public license version 2 june 1991", 3000, 4800), ("LGPL-2.1", "gnu lesser general public license version 2 1 february 1999", 3500, 5000),
    ("LGPL-3.0", "gnu lesser general public license version 3 29 june 2007", 900, 1400), ("MPL-1.1", "mozilla public license version 1 1", 3000, 4500), ("MPL-2.0", "mozilla public license version 2 0", 2200, 3000),
    ("Unlicense", "this is free and unencumbered software released into the public domain", 150, 260), ("Zlib", "zlib license", 100, 200), ("Zlib", "this software is provided as is without any express or implied warranty", 100, 200),
    ("BSD-3-Clause", "redistribution and use in source and binary forms", 190, 240), ("LGPL-2.0", "gnu library general public license terms and conditions", 2500, 4500),
)


def forms(text: str):
    yield text
    for mark in ("END OF TERMS", "APPENDIX:", "How to Apply"):
        if mark in text:
            yield text.partition(mark)[0]
    last = re.search("END OF TERMS AND CONDITIONS", text)
    if last:
        yield text[:last.end()]


def licence_of(canonical: str) -> str | None:
    words = len(canonical.split(" "))
    return next((name for name, title, least, most in TITLES if canonical.startswith(title) and least <= words <= most), None)


def entries(paths):
    found = set()
    for path in paths:
        text = path.read_text(errors="replace")
        for form in forms(text):
            canonical = canonical_text(form)
            name = licence_of(canonical)
            if name:
                found.add((name, digest_of(form), canonical.split(" ")[0]))
    return sorted(found)


if __name__ == "__main__":
    files = [f for folder in sys.argv[1:] for f in ([Path(folder)] if Path(folder).is_file() else sorted(Path(folder).rglob("*"))) if f.is_file() and f.stat().st_size < 300_000]
    for entry in entries(files):
        print(f"    {entry!r},".replace("'", '"'))
