"""Verbatim, hard-wrapped licence notices."""

import textwrap

import pytest

from receptionmart.llm import licenses

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
GPL2 = GPL.replace("software: you", "software; you").replace("Foundation, either version 3", "Foundation; either version 2")
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
BSD3 = BSD2 + """

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
NOTICES = [("MIT", 3, MIT), ("Apache-2.0", 4, APACHE), ("GPL", 2, GPL), ("GPL", 2, GPL2), ("BSD-2-Clause", 3, BSD2), ("BSD-3-Clause", 4, BSD3), ("MPL-2.0", 1, MPL)]
NOTICES += [("MIT", 2, MIT[: MIT.index("THE SOFTWARE")]), ("Unlicense", 1, "This is free and unencumbered software released\ninto the public domain.")]


@pytest.mark.parametrize("wrap", [str, lambda t: textwrap.indent(t, "# ", lambda _: True), lambda t: textwrap.indent(t.replace("\n", "\r\n"), " * ", lambda _: True),
                                  lambda t: "\n\n".join(textwrap.fill(p, 41) for p in t.split("\n\n"))])
def test_wrapped_notices(spark, wrap):
    texts = ["Intro of the file.\n\n" + wrap(t) + "\n\nMore." for _, _, t in NOTICES]
    rows = licenses.find_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["license"], r["n_sentences"]) for r in rows) == [(i, name, n) for i, (name, n, _) in enumerate(NOTICES)]
    assert all(1 <= r["first_sentence"] <= r["last_sentence"] < r["text_sentences"] - 1 for r in rows)


def test_sentences_end_with_the_paragraph(spark):
    texts = ["This Source Code Form is subject to the terms of the Mozilla Public\n\nLicense, v. 2.0.", "This is free and unencumbered software released into the\n#\npublic domain."]
    assert licenses.find_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect() == []
