"""Notices inside longer lines, over several lines, and whole licence files."""

from pyspark.sql import functions as F

from starloom.llm.licenses import license_scan

PROSE = "These pages tell of rivers and of boats that went down to the sea in autumn. " * 30
TEXTS = {
    "MIT": [
        "This project is a small tool for parsing log files quickly. Released under the MIT License.",
        "Released under the MIT License. Copyright 2024 Jane Roe and contributors.",
        f"{PROSE} Released under\n# the MIT\n# License. {PROSE}",
        "MIT License\n\nCopyright (c) 2024 Jane Roe\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\n"
        'of this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including\n'
        "without limitation the rights to use, copy, modify, merge, publish.",
        f"/* SPDX-License-Identifier: MIT */ int main; {PROSE}",
    ],
    "GPL-3.0": [
        "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\nCopyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\n"
        f"Everyone is permitted to copy and distribute verbatim copies of this license document. {PROSE}",
        f"{PROSE}\n * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public "
        "License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.",
    ],
    "Apache-2.0": [f'# Licensed under the Apache License, Version 2.0 (the "License"); you may not\n# use this file. {PROSE}'],
    None: [PROSE, "the license", "", None, "A version of the software with names and a license of no kind. " * 3],
}


def test_notices_are_found_anywhere(spark):
    cases = [(k, name, text) for k, (name, text) in enumerate((n, t) for n, some in TEXTS.items() for t in some)]
    table = spark.createDataFrame([(k, text) for k, _, text in cases], "doc_id long, text string")
    found = {r.doc_id: r.own_license for r in license_scan(spark, table, F.lit("a/b"), F.lit(False)).collect()}
    assert found == {k: name for k, name, _ in cases}
