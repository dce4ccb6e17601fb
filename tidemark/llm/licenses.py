"""License scans by conditional compression.

Lines that speak of licenses are gathered into candidate blocks. A block is compressed by itself and with each
license template as a raw zstandard dictionary; the template that saves most of the block's bytes explains it best.
The winner is confirmed by exact wording: the block must hold the template's own words in order, and the words by
which licenses of a family differ, such as versions and clauses, must not be those of another template.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Batches

#: A line with one of these is part of a candidate block.
HINT = (
    r"(?i)licen[cs]|copyright|\(c\)|©|spdx|warrant|permission|redistribut|public domain|creative commons|"
    r"all rights reserved|copyleft|\bgpl\b|\bmit\b"
)
LEAST_SAVING = 0.25
#: Lines without a hint that a notice may have before, between and behind its hinting lines.
GAP = 6
#: Words behind a license's name within which its version must stand.
VERSION_WORDS = 24


@dataclass(frozen=True)
class Template:
    """``wordings``: statements of the license; ``required``: words of which one choice each must occur."""

    license: str
    wordings: tuple[str, ...]
    required: tuple[tuple[str, ...], ...]
    barred: tuple[str, ...] = ()


#: How common licenses are stated, by their public identifiers.
TEMPLATES = (
    Template(
        "Apache-2.0",
        (
            "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
            "Licensed under the Apache License, Version 2.0.",
            "SPDX-License-Identifier: Apache-2.0",
        ),
        (("apache",), ("2.0", "2")),
    ),
    Template(
        "MIT",
        (
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "Released under the MIT License.",
            "Licensed under the MIT license.",
            "SPDX-License-Identifier: MIT",
        ),
        (("mit", "hereby granted free of charge to any person obtaining a copy"),),
    ),
    Template(
        "GPL-3.0",
        (
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
            "This work is licensed under the GNU General Public License, version 3.",
            "SPDX-License-Identifier: GPL-3.0-only",
        ),
        (("general public license", "gpl"), ("3", "3.0")),
        ("lesser", "affero", "lgpl", "agpl"),
    ),
    Template(
        "GPL-2.0",
        (
            "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
            "This work is licensed under the GNU General Public License, version 2.",
            "SPDX-License-Identifier: GPL-2.0-only",
        ),
        (("general public license", "gpl"), ("2", "2.0")),
        ("lesser", "affero", "lgpl", "agpl"),
    ),
    Template(
        "LGPL-3.0",
        (
            "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License",
            "This library is licensed under the GNU Lesser General Public License, version 3.",
            "SPDX-License-Identifier: LGPL-3.0-only",
        ),
        (("lesser general public license", "lgpl"), ("3", "3.0")),
    ),
    Template(
        "LGPL-2.1",
        (
            "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
            "This library is licensed under the GNU Lesser General Public License, version 2.1.",
            "SPDX-License-Identifier: LGPL-2.1-only",
        ),
        (("lesser general public license", "lgpl"), ("2.1",)),
    ),
    Template(
        "AGPL-3.0",
        (
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
            "This program is licensed under the GNU Affero General Public License, version 3.",
            "SPDX-License-Identifier: AGPL-3.0-only",
        ),
        (("affero general public license", "agpl"), ("3", "3.0")),
    ),
    Template(
        "MPL-2.0",
        (
            "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
            "SPDX-License-Identifier: MPL-2.0",
        ),
        (("mozilla public license", "mpl"), ("2.0", "2")),
    ),
    Template(
        "BSD-3-Clause",
        (
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
            "Licensed under the BSD 3-Clause License.",
            "SPDX-License-Identifier: BSD-3-Clause",
        ),
        (("bsd", "redistribution and use in source and binary forms"), ("3 clause", "neither the name")),
    ),
    Template(
        "BSD-2-Clause",
        (
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Licensed under the BSD 2-Clause License.",
            "SPDX-License-Identifier: BSD-2-Clause",
        ),
        (("bsd", "redistribution and use in source and binary forms"), ("2 clause", "conditions are met")),
        ("neither the name", "3 clause"),
    ),
    Template("CC0-1.0", ("To the extent possible under law, the author has waived all copyright under CC0 1.0 Universal.", "SPDX-License-Identifier: CC0-1.0"), (("cc0",),)),
    *(
        Template(
            f"CC-{kind}-4.0",
            (
                f"Licensed under CC {kind} 4.0.",
                f"This work is licensed under a Creative Commons {name} 4.0 International License.",
                f"SPDX-License-Identifier: CC-{kind}-4.0",
            ),
            ((f"cc {kind.replace('-', ' ').lower()}", name.lower().replace("-", " ")), ("4.0", "4")),
            tuple(w for k, w in (("NC", "nc"), ("NC", "noncommercial"), ("SA", "sa"), ("SA", "sharealike"), ("ND", "nd"), ("ND", "noderivatives")) if k not in kind),
        )
        for kind, name in (
            ("BY", "Attribution"),
            ("BY-SA", "Attribution-ShareAlike"),
            ("BY-NC", "Attribution-NonCommercial"),
            ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
    ),
)


def plain(text: str) -> str:
    """Lower-case words and numbers with a space on either side; full stops stay inside version numbers only."""
    return f" {' '.join(re.findall(r'cc0|[a-z]+|[0-9]+(?:[.][0-9]+)*', text.lower()))} "


def _names(templates: tuple[Template, ...]) -> tuple[re.Pattern, dict[str, tuple[Template, ...]]]:
    """What finds license names in plain words, the longest first, and the templates of each name."""
    of: dict[str, list[Template]] = {}
    for template in templates:
        for name in template.required[0]:
            of.setdefault(plain(name).strip(), []).append(template)
    # the three letters alone are a word of German
    each = [re.escape(n) + ("(?= licen[cs])" if n == "mit" else "") for n in sorted(of, key=len, reverse=True)]
    return re.compile(f"(?<= )(?:{'|'.join(each)})(?= )"), {n: tuple(t) for n, t in of.items()}


def wording_holds(block: str, template: Template) -> bool:
    """Whether a block has all the words that make the license and none that make another."""
    words = plain(block)
    found = all(any(plain(choice) in words for choice in choices) for choices in template.required)
    return found and not any(f" {w} " in words for w in template.barred)


class Scanner:
    """Compressors for all templates."""

    def __init__(self, templates: tuple[Template, ...]):
        import zstandard

        raw = lambda t: zstandard.ZstdCompressionDict("\n".join(t.wordings).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        options = {"level": 3, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.alone = zstandard.ZstdCompressor(**options)
        self.names, self.named = _names(templates)
        self.under = [(t, zstandard.ZstdCompressor(dict_data=raw(t), **options)) for t in templates]

    def ranked(self, block: str) -> list[tuple[float, Template]]:
        """Templates by the share of the block's compressed bytes that each saves, best first, ties as listed."""
        data = block.encode("utf-8", "surrogatepass")
        size = len(self.alone.compress(data))
        savings = [((size - len(c.compress(data))) / size, -i, t) for i, (t, c) in enumerate(self.under)]
        return [(s, t) for s, _, t in sorted(savings, key=lambda x: x[:2], reverse=True)]

    def stated(self, line: str) -> list[tuple[str, str, float]]:
        """``text, license, saving`` of a line, or of the sentences of a line that no license explains as a whole."""
        name, saving = self.verdict(line)
        if name:
            return [(line, name, saving)]
        sentences = re.split(r"(?<=[.!?;])\s+(?=[A-Z(])", line)
        judged = [(x, *self.verdict(x)) for x in sentences if len(sentences) > 1 and re.search(HINT, x)]
        return [x for x in judged if x[1]]

    def notices(self, block: str) -> list[tuple[int, int, str, float]]:
        """``begin, end, license, saving`` of every license that a block names with all its words, line breaks or not.

        A name's words reach to the next name of other licenses; the saving is that of the part from the first to the
        last of the words, without line breaks and comment marks.
        """
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in block)
        at = [(m.start(), m.end()) for m in re.finditer(r"cc0|[a-z]+|[0-9]+(?:[.][0-9]+)*", low)]
        places = {}
        parts = [low[a:b] for a, b in at]
        place = 1
        for i, word in enumerate(parts):
            places[place] = i
            place += len(word) + 1
        words = f" {' '.join(parts)} "
        names = list(self.names.finditer(words))
        found: list[tuple[int, int, str, float]] = []
        for k, name in enumerate(names):
            of = self.named[name[0]]
            to = next((n.start() for n in names[k + 1 :] if self.named[n[0]] != of), len(words))
            region = words[name.start() - 1 : to]
            first = places[name.start()]
            near = " ".join(parts[first : first + name[0].count(" ") + 1 + VERSION_WORDS])
            near = f" {near} "[: len(region)]
            before = re.search(r" (?:version|v) ([0-9.]+) of (?:the )?(?:gnu )?$", words[: name.start()])
            for template in of:
                begin, end, holds = name.start(), name.end(), not any(f" {w} " in region for w in template.barred)
                for choices in template.required[1:]:
                    ends = []
                    for choice in map(plain, choices):
                        where = near if choice.strip()[0].isdigit() and len(choice.split()) == 1 else region
                        if (hit := where.find(choice)) >= 0:
                            ends.append(name.start() - 1 + hit + len(choice) - 1)
                        elif before and f" {before[1]} " == choice:
                            ends.append(name.end())
                            begin = before.start() + 1
                    holds, end = holds and bool(ends), max([end, *([min(ends)] if ends else [])])
                if not holds:
                    continue
                last = places[words.rfind(" ", 0, end - 1) + 1]
                a, b = at[places[begin]][0], at[last][1]
                if name[0] == "mit":
                    b = at[last + 1][1]
                saving = self.saved(re.sub(r"\s*\n[\s*#/;%-]*", " ", block[a:b]), template)
                if saving >= LEAST_SAVING and not any(x[2] == template.license and (x[1] > a or not block[x[1] : a].strip()) for x in found):
                    found.append((a, b, template.license, saving))
        return found

    def saved(self, block: str, template: Template) -> float:
        """The share of a block's compressed bytes that a template saves."""
        data = block.encode("utf-8", "surrogatepass")
        size = len(self.alone.compress(data))
        return (size - len(next(c for t, c in self.under if t is template).compress(data))) / size

    def verdict(self, block: str) -> tuple[str | None, float]:
        """The best-ranked license whose wording holds, and its saving; None if no license explains the block."""
        for saving, template in self.ranked(block):
            if saving < LEAST_SAVING:
                break
            if wording_holds(block, template):
                return template.license, saving
        return None, 0.0


@lru_cache(maxsize=4)
def _scanner(templates: tuple[Template, ...]) -> Scanner:
    return Scanner(templates)


def candidate_blocks(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """``doc, line, block``: lines that hint at a license with up to ``GAP`` lines around, joined where these meet.

    Lines are cut and filtered in the JVM, so only candidate blocks reach Python.
    """
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    numbered = F.transform(lines, lambda x, i: F.struct(i.alias("at"), x.alias("line")))
    hinting = F.transform(F.filter(numbered, lambda x: x["line"].rlike(HINT)), lambda x: x["at"])
    start = F.array().cast("array<struct<at:int,end:int>>")

    def join(blocks, one):
        last = F.get(blocks, F.size(blocks) - 1)
        grown = F.struct(last["at"].alias("at"), one.alias("end"))
        fresh = F.struct(one.alias("at"), one.alias("end"))
        within = (F.size(blocks) > 0) & (one - last["end"] <= 2 * GAP)
        return F.when(within, F.concat(F.slice(blocks, 1, F.size(blocks) - 1), F.array(grown))).otherwise(F.concat(blocks, F.array(fresh)))

    picked = docs.where(F.col(text).rlike(HINT)).select(F.col(doc).alias("doc"), lines.alias("lines"), hinting.alias("hinting"))
    blocks = picked.select("doc", "lines", F.explode(F.aggregate("hinting", start, join)).alias("b"))
    line = F.greatest(F.col("b.at") - GAP, F.lit(0))
    return blocks.select("doc", line.alias("line"), F.array_join(F.slice("lines", line + 1, F.col("b.end") + GAP - line + 1), "\n").alias("block"))


def judged(scanner: Scanner, block: str) -> list[tuple[int, str, str, float]]:
    """``line, text, license, saving`` of all that a block states: by lines, by notices over lines, by runs of hinting lines."""
    parts = block.split("\n")
    hints = [bool(re.search(HINT, p, re.ASCII)) for p in parts]
    found = [(k, *x) for k, part in enumerate(parts) if hints[k] for x in scanner.stated(part)]
    taken = {(k, x) for k, _, x, _ in found}
    covered = {k for k, _ in taken}
    for a, b, name, saving in scanner.notices(block):
        first, last = block.count("\n", 0, a), block.count("\n", 0, b)
        covered.update(range(first, last + 1))
        if not any((k, name) in taken for k in range(first, last + 1)):
            found.append((first, "\n".join(parts[first : last + 1]), name, saving))
    k = 0
    while k < len(parts):
        end = k
        while end < len(parts) and hints[end]:
            end += 1
        if end - k > 1 and covered.isdisjoint(range(k, end)):
            run = "\n".join(parts[k:end])
            name, saving = scanner.verdict(run)
            if name:
                found.append((k, run, name, saving))
        k = max(end, k + 1)
    return sorted(found, key=lambda x: x[0])


def scan(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``doc_id, line, license, saving, block`` for each block of each text that states a license.

    ``line`` counts from 0; ``saving`` is the share of the block's compressed size that the template takes off,
    rounded to six places. Lines are judged one by one, a line that no license explains sentence by
    sentence, and all licenses that a block names over line ends or beside another are added with the lines they take.
    NULL and empty texts state nothing. Rows that repeat are each reported, with NULL ids too. No rows: no rows.
    """
    blocks = candidate_blocks(docs, doc, text)

    def judge(batches: Batches) -> Batches:
        scanner = _scanner(templates)
        for batch in batches:
            of, line, license_, saving, stated = [], [], [], [], []
            for i, (at, block) in enumerate(zip(batch.column("line").to_pylist(), batch.column("block").to_pylist())):
                found = [(at + k, *x) for k, *x in judged(scanner, block)]
                for where, part, name, share in found:
                    of.append(i)
                    line.append(where)
                    license_.append(name)
                    saving.append(round(share, 6))
                    stated.append(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(of, pa.int64())), pa.array(line, pa.int32()), pa.array(license_, pa.string()), pa.array(saving, pa.float64()), pa.array(stated, pa.string())],
                names=["doc_id", "line", "license", "saving", "block"],
            )

    kind = blocks.schema["doc"].dataType.simpleString()
    return blocks.mapInArrow(judge, f"doc_id {kind}, line int, license string, saving double, block string")
