"""Every licence of the inventory by its usual words, and texts that are slow to scan if one is careless."""

import time

import pytest

from sunfleet.llm import html_extract, license_scan

NAMES = {
    "Zlib": "zlib License", "BSL-1.0": "Boost Software License, Version 1.0", "EPL-2.0": "Eclipse Public License v2.0", "CPL-1.0": "Common Public License Version 1.0",
    "IPL-1.0": "IBM Public License, Version 1.0", "CDDL-1.1": "Common Development and Distribution License 1.1", "Artistic-2.0": "Artistic License 2.0", "Unlicense": "Unlicense",
    "WTFPL-2": "Do What The Fuck You Want To Public License, Version 2", "PostgreSQL": "PostgreSQL License", "PSF-2": "Python Software Foundation License Version 2",
    "OFL-1.1": "SIL Open Font License, Version 1.1", "NCSA": "University of Illinois/NCSA Open Source License", "EUPL-1.2": "European Union Public Licence 1.2", "MS-PL": "Microsoft Public License",
    "MS-RL": "Microsoft Reciprocal License", "PHP-3.01": "PHP License, version 3.01", "Vim": "Vim License", "Ruby": "Ruby License", "OpenSSL": "OpenSSL License", "X11": "X11 License",
    "AFL-3.0": "Academic Free License version 3.0", "OSL-3.0": "Open Software License version 3.0", "CeCILL-2.1": "CeCILL License 2.1", "LPPL-1.3": "LaTeX Project Public License 1.3",
    "QPL-1.0": "Q Public License version 1.0", "NPL-1.1": "Netscape Public License Version 1.1", "SPL-1.0": "Sun Public License Version 1.0", "APSL-2.0": "Apple Public Source License Version 2.0",
    "ECL-2.0": "Educational Community License, Version 2.0", "UPL-1.0": "Universal Permissive License v 1.0", "MulanPSL-2": "Mulan Permissive Software License, Version 2", "ODbL-1.0": "Open Database License 1.0",
    "OGL-3.0": "Open Government Licence v3.0", "SSPL-1": "Server Side Public License v1", "BUSL-1.1": "Business Source License 1.1", "Elastic-2.0": "Elastic License 2.0", "JSON": "JSON License", "Beerware": "Beerware License",
}


@pytest.mark.parametrize("licence", sorted(NAMES))
def test_licences_by_name(licence):
    name = NAMES[licence]
    for text in (f"This project is licensed under the {name}.", f"Distributed under the terms of the {name}; see LICENSE.", f"{name}\n\nCopyright (c) 2020 Bob"):
        assert license_scan.recognise(text)[1] == [licence], text


@pytest.mark.parametrize(("text", "licence"), [
    ("MIT License\n\nCopyright (c) 2020 Bob\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software", "MIT"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0", "CC-BY-NC-ND-4.0"),
    ("Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "BSD-style"),
    ("BSD 3-Clause License", "BSD-3-Clause"), ("Apache License\nVersion 2.0, January 2004", "Apache-2.0"), ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", "GPL-3"),
    ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999", "LGPL-2.1"), ("GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007", "AGPL-3"),
    ("Mozilla Public License Version 2.0", "MPL-2.0"), ("Licensed under the Apache License, Version 2.0", "Apache-2.0"), ("SPDX-License-Identifier: MIT", "SPDX:MIT"),
])
def test_titles_and_references(text, licence):
    assert license_scan.recognise(text)[1] == [licence]


def test_plain_prose_names_no_licence():
    for text in ("The driver had a license.", "He published the open letter under a pen name.", "We ruby the page. The vim of the boost was elastic."):
        assert license_scan.recognise(text)[1] == []


@pytest.mark.parametrize("line", ["copyright 2001 bob\n", "in no event shall the bob\n", "the software is provided by bob\n", "neither the name of bob\n", "licensed under the \n"])
def test_a_hundred_thousand_licence_lines(line):
    start = time.perf_counter()
    license_scan.recognise(line * 100_000)
    assert time.perf_counter() - start < 12


@pytest.mark.parametrize("markup", ["<div>xx", "<font>x", "<b><i></b>x", "<div class='k'>yy"])
def test_forty_thousand_open_elements(markup):
    start = time.perf_counter()
    blocks = html_extract.leaf_blocks(markup * 40_000)
    assert blocks and len(html_extract.features(blocks)) == len(blocks) and time.perf_counter() - start < 10


def test_features_know_all_elements_around():
    blocks = html_extract.leaf_blocks("<article class='a b'><p>one</p><div id='c'><b>two</b></div></article><nav>three</nav>")
    assert [(b.text, sorted(b.tags), b.parent, sorted(b.words), b.inside, b.between, sorted(b.inline)) for b in blocks] == [
        ("one", ["article", "p"], "p", ["a", "b"], True, False, []), ("two", ["article", "div"], "div", ["a", "b", "c"], True, False, ["b"]), ("three", ["nav"], "nav", [], False, False, []),
    ]
