"""Licences that are stated inside a text."""

import textwrap

from snapcredit.llm.licences import TEMPLATES, scan_licences

PROSE = "\n".join(f"line {i} of a longer document about the weather and other things" for i in range(40))


def test_passages_inside(spark):
    wrapped = {name: textwrap.fill(TEMPLATES[name], 60) for name in TEMPLATES if len(TEMPLATES[name].split()) >= 20}
    rows = [(name, f"{PROSE}\n\n/*\n{body}\n*/\n{PROSE}") for name, body in wrapped.items()]
    rows += [
        ("edited", f"{PROSE}\n" + wrapped["MIT-text"].replace("free of charge", "for nothing") + f"\n{PROSE}"),
        ("sentence", f"{PROSE}\nCopyright 2020 X. All rights reserved."),
        ("wrapped", f"{PROSE}.\nSee below. Released under the\nMIT License. End."),
        ("none", f"{PROSE}\nThe software is ours, and all rights of way are reserved for walkers."),
        ("null", None),
    ]
    done = scan_licences(spark.createDataFrame(rows, "name string, text string"))
    got = {r.name: [(x.line, x.licence) for x in r.licences] for r in done.collect()}
    expected = {name: [(42, name)] for name in wrapped} | {
        "edited": [(40, "MIT-text")], "sentence": [(40, "reserved")], "wrapped": [(40, "MIT")], "none": [], "null": [],
    }
    # Its first line alone is the short form.
    expected["Apache-2.0-notice"] = [(42, "Apache-2.0"), (42, "Apache-2.0-notice")]
    assert got == expected
