"""Notices in common use and the licence of each."""

import pytest

from folioframe.llm import licenses

GNU = "This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
NOTICES = [
    (GNU.format("program", ";", "", ";", "2"), "GPL-2.0"), (GNU.format("program", ":", "", ",", "3"), "GPL-3.0"), (GNU.format("file", ";", "", ";", "2"), "GPL-2.0"),
    (GNU.format("library", ";", "Lesser ", ";", "2.1"), "LGPL-2.1"), (GNU.format("library", ";", "Lesser ", ";", "3"), "LGPL-3.0"), (GNU.format("program", ":", "Lesser ", ",", "3"), "LGPL-3.0"),
    (GNU.format("program", ":", "Affero ", ",", "3"), "AGPL-3.0"), (GNU.format("library", ";", "Library ", ";", "2"), None),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"), ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("Licensed under the GNU General Public License v2", "GPL-2.0"), ("Licensed under the GNU General Public License v3.0", "GPL-3.0"),
    ("Licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"), ("Licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("# SPDX-License-Identifier: MIT", "MIT"), ("// SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("/* SPDX-License-Identifier: GPL-2.0-only */", "GPL-2.0"),
    ("SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0"), ("SPDX-License-Identifier: LGPL-2.1+", "LGPL-2.1"), ("SPDX-License-Identifier: AGPL-3.0-only", "AGPL-3.0"), ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", None), ("SPDX-License-Identifier: NoSuch-1.0", None),
    ("This package is licensed under the terms of the MIT license.", "MIT"), ("Released under the MIT License.", "MIT"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "Apache-2.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "MPL-2.0"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0", "EPL-2.0"),
    ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"), ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0"), ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
]


def named(index, text, least=0.7):
    if stated := licenses.declared(text):
        return stated
    name, score = index.best(licenses.tokens(text))
    return name if score >= least else None


@pytest.mark.parametrize("frequencies", [None, {"general": 600.0, "gnu": 600.0, "public": 650.0, "license": 990.0, "3": 500.0, "2": 20.0, "version": 900.0, "the": 990.0}])
def test_notices(frequencies):
    """The answer does not turn on what else is in the corpus."""
    index = licenses.Index(1000.0 if frequencies else 0, frequencies)
    assert [(t, named(index, t)) for t, _ in NOTICES] == NOTICES


def test_no_version_no_name():
    index = licenses.Index()
    assert named(index, "This work is licensed under the GNU General Public License.") is None
    assert licenses.agrees("GPL-3.0", "gnu general public license version 3") and not licenses.agrees("GPL-3.0", "gnu lesser general public license version 3")
    assert not licenses.agrees("CC-BY-4.0", "licensed under cc by nc 4.0") and licenses.agrees("CC-BY-4.0", "sa nd licensed under cc by 4.0 nd sa")


def test_scan(spark):
    """Through the whole scan, with other documents around."""
    rows = [(k, t, f"src/{k}/x.c") for k, (t, _) in enumerate(NOTICES)] + [(100 + k, "Plain words on a line.\n" * 5, f"doc/{k}/a") for k in range(20)] + [(200, None, "doc/n"), (201, "", None)]
    files = spark.createDataFrame(rows, "doc_id long, text string, path string").repartition(3)
    from pyspark.sql import functions as F

    got = {r["id"]: r["licence"] for r in licenses.scan(spark, files, id_col="doc_id", path=F.col("path"), text_col="text").collect()}
    assert {k: got[k] for k in range(len(NOTICES))} == {k: x for k, (_, x) in enumerate(NOTICES)}
    assert all(got[k] is None for k in (*range(100, 120), 200, 201))
