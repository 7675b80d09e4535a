"""Licence wordings inside documents, by conditional compression.

Blocks of lines with licence vocabulary are candidates. A block is compressed alone and once with each
template as raw dictionary; the more a template saves, the closer it is. Long blocks are cut into overlapping
windows. Every template is held against the wording, whatever it saves; the longest that differs from it in no
telling word and in few others is the licence, of equally long ones the one that saves more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from roadbook.llm.frames import blocks

# Public licence notices. <...> stands for any few words.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation; either version 2 of the License, or (at your"
        " option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at"
        " your option) any later version.",
        "SPDX-License-Identifier: LGPL-2.1",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation, either version 3 of the License, or (at"
        " your option) any later version.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation, either version 3 of the License, or (at"
        " your option) any later version.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero"
        " General Public License as published by the Free Software Foundation, either version 3 of the License, or (at"
        " your option) any later version.",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: Redistributions of source code must retain the above copyright notice,"
        " this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the"
        " above copyright notice, this list of conditions and the following disclaimer in the documentation and/or"
        " other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND"
        " CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED"
        " WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
        "Licensed under the BSD 2-Clause License.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: Redistributions of source code must retain the above copyright notice,"
        " this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the"
        " above copyright notice, this list of conditions and the following disclaimer in the documentation and/or"
        " other materials provided with the distribution. Neither the name of <owner> nor the names of its"
        " contributors may be used to endorse or promote products derived from this software without specific prior"
        " written permission.",
        "Licensed under the BSD 3-Clause License.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related rights to this work."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-ND-4.0": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0."],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0."],
}
#: Words that tell licences apart: none may be missing or added. Numbers tell them apart as well.
TELLING = frozenset(
    "mit apache gnu gpl lgpl agpl lesser affero library general mozilla mpl bsd isc cc by sa nc nd creative commons"
    " attribution sharealike noncommercial noderivatives not neither without public domain unlicense".split()
)
#: What a document must hold, in lower case, to be looked at; and a line to be part of a candidate block.
VOCABULARY = (
    "licen", "copyright", "permission", "redistribut", "public domain", "free software", "warrant", "spdx-", "mozilla.org/mpl",
)
#: Lines without licence vocabulary that a block may reach over; telling words aside, the share of words that may differ.
GAP, DIFFERING = 3, 0.12
LEVEL = 19

_LINE = re.compile("|".join(map(re.escape, VOCABULARY)))
#: A number that begins an item of a list, and what stands before one: nothing, an end of a clause, "and" or "or".
_ITEM = re.compile(r"(?<![\w.(])\(?\d{1,2}[.)]\s+(?=[A-Z])")
_BEFORE_ITEM = re.compile(r"(?:^|[:;.,)]|\b(?:and|or))[\s#*/;%>|-]*$", re.IGNORECASE)
_WORD = re.compile(r"<[^<>\s]+>|[^\W_]+(?:\.[^\W_]+)*")


@dataclass
class Template:
    license: str
    form: int
    text: str
    words: list[str] = field(default_factory=list)
    compressor: zstandard.ZstdCompressor | None = None


@lru_cache(maxsize=1)
def templates() -> list[Template]:
    """Templates with compressors that hold them as raw dictionaries; one set per worker."""
    out = []
    for name, texts in TEMPLATES.items():
        for form, text in enumerate(texts):
            raw = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_checksum=False, write_dict_id=False)
            out.append(Template(name, form, text, [w for w, _, _ in words(text)], compressor))
    return out


def words(text: str) -> list[tuple[str, int, int]]:
    """Words in lower case with their places; numbers that begin items of a list are no words."""
    items = {m.start() + (m.group()[0] == "(") for m in _ITEM.finditer(text) if _BEFORE_ITEM.search(text, max(0, m.start() - 80), m.start())}
    return [(m.group().lower(), m.start(), m.end()) for m in _WORD.finditer(text) if m.start() not in items]


def candidate_blocks(text: str) -> Iterator[tuple[int, int]]:
    """Begin and end of runs of lines with licence vocabulary, over short gaps, with up to ``GAP`` lines around each."""
    lines = text.splitlines(keepends=True)
    starts = [0, *accumulate(map(len, lines))]
    first = last = None
    for k, line in enumerate(lines):
        if _LINE.search(line.lower()):
            if first is not None and k - last > GAP + 1:
                yield starts[max(0, first - GAP)], starts[min(len(lines), last + 1 + GAP)]
                first = None
            first, last = k if first is None else first, k
    if first is not None:
        yield starts[max(0, first - GAP)], starts[min(len(lines), last + 1 + GAP)]


@lru_cache(maxsize=1)
def reach() -> int:
    """Characters that a wording may take: twice the longest template."""
    return 2 * max(len(t.text) for t in templates())


def windows(begin: int, end: int) -> Iterator[tuple[int, int]]:
    """Parts that cover a block; each stretch of ``reach`` characters is whole in one of them."""
    while end - begin > 2 * reach():
        yield begin, begin + 2 * reach()
        begin += reach()
    yield begin, end


def possible(template: list[str], block: set[str]) -> bool:
    """Whether a wording with these words can be in a block with those: no telling word and few others are missing."""
    lost = [w for w in template if w not in block and not w.startswith("<")]
    return len(lost) <= DIFFERING * len(template) and not any(w in TELLING or w[0].isdigit() for w in lost)


def ranked(block: str, among: list[Template]) -> list[tuple[float, Template]]:
    """Templates by the share of the block's compressed size that they save, largest first; it may be negative."""
    raw = block.encode()
    alone = len(zstandard.ZstdCompressor(level=LEVEL, write_checksum=False).compress(raw))
    saved = [(1 - len(t.compressor.compress(raw)) / alone, t) for t in among]
    return sorted(saved, key=lambda s: (-s[0], s[1].license, s[1].form))


def differences(template: list[str], block: list[str]) -> tuple[int, int, list[str], bool]:
    """Begin and end of the wording in the block's words, how it differs, and whether a telling word does.

    Words of the block before the first and after the last common word are not part of the wording.
    """
    matcher = SequenceMatcher(None, template, block, autojunk=False)
    common = [m for m in matcher.get_matching_blocks() if m.size]
    if not common:
        return 0, 0, ["-" + w for w in template], True
    begin, end = common[0].b, common[-1].b + common[-1].size
    out, telling = [], False
    for tag, i, j, k, m in matcher.get_opcodes():
        k, m = max(k, begin), min(m, end)
        if tag == "equal" or (i == j and k >= m):
            continue
        lost, added = template[i:j], block[k:m]
        if lost and all(w.startswith("<") for w in lost) and len(added) <= 6:
            continue  # what a placeholder stands for
        out += ["-" + w for w in lost] + ["+" + w for w in added]
        telling |= any(w in TELLING or w[0].isdigit() for w in [*lost, *added])
    return begin, end, out, telling


def _closest(window: str) -> tuple[Template, float, int, int, list[str]] | None:
    """The template whose wording is in a window, the share it saves, begin and end, differing words."""
    own = words(window)
    if not own or not _LINE.search(window.lower()):
        return None
    plain = [w for w, _, _ in own]
    present = set(plain)
    tried: list[tuple] = []
    for saved, template in ranked(window, [t for t in templates() if possible(t.words, present)]):
        first, last, differ, telling = differences(template.words, plain)
        if not telling and len(differ) <= DIFFERING * len(template.words):
            tried.append((template, saved, own[first][1], own[last - 1][2], differ))
    # among close wordings the longer one says more
    return max(tried, key=lambda t: (len(t[0].words) - len(t[4]), t[1]), default=None)


def scan_text(text: str | None) -> list[tuple[str, int, int, int, float, list[str]]]:
    """Licences of a text: name, form, begin, end, share saved, differing words.

    After a licence is found in a block, what the block holds before and behind it is scanned as well.
    """
    found, open_ = [], list(candidate_blocks(text)) if text else []
    while open_:
        block_begin, block_end = open_.pop()
        for begin, end in windows(block_begin, block_end):
            hit = _closest(text[begin:end])
            if hit:
                template, saved, first, last, differ = hit
                start, stop = begin + first, begin + last
                found.append((template.license, template.form, start, stop, saved, differ))
                # what lies before is whole in this window or in one without a licence
                open_ += [(begin, start), (stop, block_end)]
                break
    return sorted(found, key=lambda f: (f[2], f[0]))


def may_hold_license(text: Column) -> Column:
    """Whether a text has any licence vocabulary."""
    low = F.lower(text)
    found = low.contains(VOCABULARY[0])
    for part in VOCABULARY[1:]:
        found |= low.contains(part)
    return found


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per licence wording found: ``id``, ``license``, ``form``, ``begin``, ``end``, ``saved``, ``differences``.

    ``begin`` and ``end`` are offsets into the whole text, ``saved`` is the share of the window's compressed
    size that the template saves, which may be negative, ``differences`` lists words missing (-) and added (+). Null and empty texts
    have none. A text may hold several, repeated rows are each scanned. Ties between templates go by name.
    """
    named = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    schema = T.StructType([
        named.schema["id"],
        T.StructField("license", T.StringType(), False), T.StructField("form", T.IntegerType(), False),
        T.StructField("begin", T.IntegerType(), False), T.StructField("end", T.IntegerType(), False),
        T.StructField("saved", T.DoubleType(), False), T.StructField("differences", T.ArrayType(T.StringType(), False), False),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for begin, end in blocks(batch.column(1)):
                ids = batch.column(0).slice(begin, end - begin)
                texts = batch.column(1).slice(begin, end - begin).to_pylist()
                hits = [(row, *hit) for row, text in enumerate(texts) for hit in scan_text(text)]
                columns = list(zip(*hits, strict=True)) or [[]] * 7
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(columns[0], pa.int64())).cast(arrow.field(0).type)]
                    + [pa.array(columns[k], arrow.field(k).type) for k in range(1, 7)],
                    schema=arrow,
                )

    return named.where(may_hold_license(F.col("text"))).mapInArrow(run, schema)
