"""Licences outside the families are reported as unknown, never as a family whose text or notice resembles theirs."""

from semlayer.llm.licenses import license_scan

OTHERS = [
    "GNU Lesser General Public License version 2.1",
    "Dieses Programm steht unter der GNU General Public License, Version 2.",
    "This work is licensed under the GNU General Public License, version 2.",
    "Licensed under CC BY-SA 4.0.",
    "Distributed under the GPLv2, see the file COPYING.",
]
FAMILIES = [
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0"),
    ("Licensed under CC BY 4.0.", "cc-by-4.0"),
    ("Released under the MIT License. The fonts beside it are under the LGPL.", "mit"),
]


def test_other_licences_are_unknown(documents):
    prose = [f"The {a} went to the {b} and stayed there for {n} days." for n in range(40) for a, b in [("fox", "river"), ("tailor", "harbour")]]
    rows = [(i, "\n".join([*prose[i::8], text])) for i, text in enumerate([*OTHERS, *(t for t, _ in FAMILIES)])]
    found = {row.doc_id: row for row in license_scan(documents(rows)).collect()}
    assert [(found[i].n_license, found[i].n_unknown, found[i].family) for i in range(len(OTHERS))] == [(0, 1, None)] * len(OTHERS)
    assert [found[len(OTHERS) + i].family for i in range(len(FAMILIES))] == [family for _, family in FAMILIES]
