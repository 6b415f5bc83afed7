"""Licence recognition by sentences: known sentences, then ordered rules over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.storage import staged

# Licence sentences in normal form (lower case, one space between runs of
# letters and digits): titles, grants and notices as published with the licences, and the
# usual one-line mentions. ``*`` stands for a name of up to ``NAME_WORDS`` words.
SENTENCES = {
    "mit-name": "released under the mit license",
    "mit-name-2": "licensed under the mit license",
    "mit-title": "the mit license",
    "mit-title-2": "mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files the software to deal in the software without restriction including "
    "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
    "copies of the software and to permit persons to whom the software is furnished to do so subject to "
    "the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all "
    "copies or substantial portions of the software",
    "mit-notice-2": "the above copyright notice and this permission notice including the next paragraph "
    "shall be included in all copies or substantial portions of the software",
    "apache-name": "licensed under the apache license version 2 0",
    "apache-name-2": "licensed under the apache license version 2 0 the license",
    "apache-name-use": "licensed under the apache license version 2 0 the license you may not use this "
    "file except in compliance with the license",
    "apache-title": "apache license version 2 0 january 2004",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "gpl3-name": "this work is licensed under the gnu general public license version 3",
    "gpl3-name-2": "licensed under the gnu general public license version 3",
    "gpl3-title": "gnu general public license version 3 29 june 2007",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the "
    "terms of the gnu general public license as published by the free software foundation either "
    "version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any "
    "warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl2-name": "this work is licensed under the gnu general public license version 2",
    "gpl2-name-2": "licensed under the gnu general public license version 2",
    "gpl2-title": "gnu general public license version 2 june 1991",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the "
    "terms of the gnu general public license as published by the free software foundation either "
    "version 2 of the license or at your option any later version",
    "gpl2-only": "this program is free software you can redistribute it and or modify it under the "
    "terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl2-only-2": "this program is free software you can redistribute it and or modify it under the "
    "terms of the gnu general public license as published by the free software foundation version 2 "
    "of the license",
    "lgpl2-title": "gnu library general public license version 2 june 1991",
    "lgpl2-free": "this library is free software you can redistribute it and or modify it under the "
    "terms of the gnu library general public license as published by the free software foundation "
    "either version 2 of the license or at your option any later version",
    "lgpl21-title": "gnu lesser general public license version 2 1 february 1999",
    "lgpl21-free": "this library is free software you can redistribute it and or modify it under the "
    "terms of the gnu lesser general public license as published by the free software foundation "
    "either version 2 1 of the license or at your option any later version",
    "lgpl3-title": "gnu lesser general public license version 3 29 june 2007",
    "lgpl3-free": "this library is free software you can redistribute it and or modify it under the "
    "terms of the gnu lesser general public license as published by the free software foundation "
    "either version 3 of the license or at your option any later version",
    "lgpl3-free-2": "this program is free software you can redistribute it and or modify it under the "
    "terms of the gnu lesser general public license as published by the free software foundation "
    "either version 3 of the license or at your option any later version",
    "agpl3-title": "gnu affero general public license version 3 19 november 2007",
    "agpl3-free": "this program is free software you can redistribute it and or modify it under the "
    "terms of the gnu affero general public license as published by the free software foundation "
    "either version 3 of the license or at your option any later version",
    "mpl-title": "mozilla public license version 2 0",
    "mpl-form": "this source code form is subject to the terms of the mozilla public license v",
    "mpl-two": "2 0",
    "isc-title": "isc license",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or "
    "without fee is hereby granted provided that the above copyright notice and this permission notice "
    "appear in all copies",
    "isc-grant-2": "permission to use copy modify and distribute this software for any purpose with or "
    "without fee is hereby granted provided that the above copyright notice and this permission notice "
    "appear in all copies",
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose with or "
    "without fee is hereby granted",
    "zlib-warranty": "this software is provided as is without any express or implied warranty",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including "
    "commercial applications and to alter it and redistribute it freely subject to the following "
    "restrictions",
    "bsl-title": "boost software license version 1 0 august 17th 2003",
    "bsl-name": "distributed under the boost software license version 1 0",
    "epl-title": "eclipse public license v 2 0",
    "epl-made": "this program and the accompanying materials are made available under the terms of the "
    "eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "unlicense-free": "this is free and unencumbered software released into the public domain",
    "cc-by-nc-name": "licensed under cc by nc 4 0",
    "cc-by-nc-work": "this work is licensed under a creative commons attribution noncommercial 4 0 "
    "international license",
    "cc-by-sa-name": "licensed under cc by sa 4 0",
    "cc-by-sa-work": "this work is licensed under a creative commons attribution sharealike 4 0 "
    "international license",
    "cc-by-name": "licensed under cc by 4 0",
    "cc-by-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc0-name": "licensed under cc0 1 0",
    "cc0-title": "cc0 1 0 universal",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list "
    "of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this "
    "list of conditions and the following disclaimer in the documentation and or other materials "
    "provided with the distribution",
    "bsd-advert": "all advertising materials mentioning features or use of this software must display "
    "the following acknowledgement this product includes software developed by *",
    "bsd-endorse": "neither the name of * nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission",
    "bsd-endorse-2": "nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission",
    "bsd-endorse-3": "the name of the author may not be used to endorse or promote products derived "
    "from this software without specific prior written permission",
    "bsd-endorse-4": "the names of its contributors may not be used to endorse or promote products "
    "derived from this software without specific prior written permission",
    "rights": "all rights reserved",
}

# Rules: the licence, and the sentences that must follow one another.
RULES = {
    "mit-1": ("MIT", ["mit-name"]),
    "mit-2": ("MIT", ["mit-name-2"]),
    "mit-3": ("MIT", ["mit-title", "mit-notice"]),
    "mit-4": ("MIT", ["mit-title-2", "mit-notice"]),
    "mit-5": ("MIT", ["mit-grant", "mit-notice"]),
    "mit-6": ("MIT", ["mit-grant", "mit-notice-2"]),
    "apache-1": ("Apache-2.0", ["apache-name"]),
    "apache-2": ("Apache-2.0", ["apache-name-2", "apache-use", "apache-copy"]),
    "apache-3": ("Apache-2.0", ["apache-name-use", "apache-copy"]),
    "apache-4": ("Apache-2.0", ["apache-title"]),
    "gpl3-1": ("GPL-3.0", ["gpl3-name"]),
    "gpl3-2": ("GPL-3.0", ["gpl3-name-2"]),
    "gpl3-3": ("GPL-3.0", ["gpl-free", "gpl-hope"]),
    "gpl3-4": ("GPL-3.0", ["gpl3-title"]),
    "gpl2-1": ("GPL-2.0", ["gpl2-name"]),
    "gpl2-2": ("GPL-2.0", ["gpl2-name-2"]),
    "gpl2-3": ("GPL-2.0", ["gpl2-free"]),
    "gpl2-4": ("GPL-2.0", ["gpl2-only"]),
    "gpl2-5": ("GPL-2.0", ["gpl2-only-2"]),
    "gpl2-6": ("GPL-2.0", ["gpl2-title"]),
    "lgpl2-1": ("LGPL-2.0", ["lgpl2-title"]),
    "lgpl2-2": ("LGPL-2.0", ["lgpl2-free"]),
    "lgpl21-1": ("LGPL-2.1", ["lgpl21-title"]),
    "lgpl21-2": ("LGPL-2.1", ["lgpl21-free"]),
    "lgpl3-1": ("LGPL-3.0", ["lgpl3-title"]),
    "lgpl3-2": ("LGPL-3.0", ["lgpl3-free"]),
    "lgpl3-3": ("LGPL-3.0", ["lgpl3-free-2"]),
    "agpl3-1": ("AGPL-3.0", ["agpl3-title"]),
    "agpl3-2": ("AGPL-3.0", ["agpl3-free"]),
    "mpl-1": ("MPL-2.0", ["mpl-title"]),
    "mpl-2": ("MPL-2.0", ["mpl-form", "mpl-two"]),
    "isc-1": ("ISC", ["isc-title"]),
    "isc-2": ("ISC", ["isc-grant"]),
    "isc-3": ("ISC", ["isc-grant-2"]),
    "0bsd-1": ("0BSD", ["0bsd-grant"]),
    "zlib-1": ("Zlib", ["zlib-warranty", "zlib-grant"]),
    "bsl-1": ("BSL-1.0", ["bsl-title"]),
    "bsl-2": ("BSL-1.0", ["bsl-name"]),
    "epl-1": ("EPL-2.0", ["epl-title"]),
    "epl-2": ("EPL-2.0", ["epl-made"]),
    "unlicense-1": ("Unlicense", ["unlicense-free"]),
    "cc-by-nc-1": ("CC-BY-NC-4.0", ["cc-by-nc-name"]),
    "cc-by-nc-2": ("CC-BY-NC-4.0", ["cc-by-nc-work"]),
    "cc-by-sa-1": ("CC-BY-SA-4.0", ["cc-by-sa-name"]),
    "cc-by-sa-2": ("CC-BY-SA-4.0", ["cc-by-sa-work"]),
    "cc-by-1": ("CC-BY-4.0", ["cc-by-name"]),
    "cc-by-2": ("CC-BY-4.0", ["cc-by-work"]),
    "cc0-1": ("CC0-1.0", ["cc0-name"]),
    "cc0-2": ("CC0-1.0", ["cc0-title"]),
    "bsd2-1": ("BSD-2-Clause", ["bsd-source", "bsd-binary"]),
    "bsd3-1": ("BSD-3-Clause", ["bsd-source", "bsd-binary", "bsd-endorse"]),
    "bsd3-2": ("BSD-3-Clause", ["bsd-source", "bsd-binary", "bsd-endorse-2"]),
    "bsd3-3": ("BSD-3-Clause", ["bsd-source", "bsd-binary", "bsd-endorse-3"]),
    "bsd3-4": ("BSD-3-Clause", ["bsd-source", "bsd-binary", "bsd-endorse-4"]),
    "bsd4-1": ("BSD-4-Clause", ["bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse"]),
    "bsd4-2": ("BSD-4-Clause", ["bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse-2"]),
    "bsd4-3": ("BSD-4-Clause", ["bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse-3"]),
    "bsd4-4": ("BSD-4-Clause", ["bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse-4"]),
    "reserved-1": ("All-Rights-Reserved", ["rights"]),
}

# SPDX lines: what follows ``SPDX-License-Identifier:``, and the licences it names.
SPDX = {name: [name] for name in sorted({licence for licence, _ in RULES.values()} - {"All-Rights-Reserved"})}
SPDX |= {f"{name}-{kind}": [name] for name in SPDX if "GPL" in name for kind in ("only", "or-later")}
SPDX |= {"MIT OR Apache-2.0": ["MIT", "Apache-2.0"], "Apache-2.0 OR MIT": ["Apache-2.0", "MIT"]}
for _text, _names in SPDX.items():
    _line = "spdx " + _text.lower().replace("-", " ").replace(".", " ")
    SENTENCES[_line] = _line.replace("spdx", "spdx license identifier", 1)
    RULES |= {f"{_line} {_k}": (_name, [_line]) for _k, _name in enumerate(_names)}

# Words a ``*`` stands for.
NAME_WORDS = 16

# Other sentences allowed between two of a rule.
GAP = 3


def normal_lines(text: Column) -> Column:
    """Sentences as arrays of lines in normal form, without empty ones.

    A sentence ends at ``.``, ``!`` or ``?`` before white space and at a line without letters
    or digits (blank, or a bare comment mark). Its other line breaks cut it into lines;
    marks before and after them are no letters and drop out.
    """
    ended = F.regexp_replace(F.lower(text), r"([.!?])\s+", "$1\n\n")
    closed = F.regexp_replace(ended, r"([.!?][^\p{L}\p{N}\s]+)[^\S\n]*\n", "$1\n\n")
    plain = F.regexp_replace(closed, r"[^\p{L}\p{N}\n]+", " ")
    tight = F.regexp_replace(F.regexp_replace(plain, r" ?\n ?", "\n"), r"\n{2,}", "\n\n")
    cut = F.split(F.regexp_replace(tight, r"^[ \n]+|[ \n]+$", ""), "\n\n")
    return F.transform(F.array_remove(cut, ""), lambda sentence: F.split(sentence, "\n"))


def wrapped_places(lines: Column, sentences: dict[str, str]) -> Column:
    """``(sent, text, wrapped)`` of every line in order; ``wrapped`` are the ``(known, n_lines)`` from there.

    A known sentence is wrapped if it is the text of several whole lines of one sentence.
    Lines are put together only where one begins like a known sentence, and no further
    than the longest of these goes. Sentences with a ``*`` are found here on one line too.
    """
    fixed = {k: v for k, v in sentences.items() if "*" not in v}
    open_ones = {k: v for k, v in sentences.items() if "*" in v}
    table = F.array(
        *(F.struct(F.lit(k).alias("known"), F.lit(v).alias("sentence")) for k, v in fixed.items())
    )

    def begins(known: dict[str, str]) -> list[str]:
        return sorted({" ".join(v.split(" ")[:n]) for v in known.values() for n in (1, 2)})

    most_words = max((len(v.split(" ")) for v in sentences.values()), default=1) + NAME_WORDS
    most_chars = max(map(len, sentences.values()), default=1) + 16 * NAME_WORDS
    none = F.array().cast("array<struct<known:string,n_lines:int>>")

    def at(own: Column, k: Column) -> Column:
        near = F.transform(F.slice(own, k + 1, most_words), lambda x: F.substring(x, 1, most_chars + 1))
        rest = F.array_join(near, "\n")

        def whole(one: Column) -> Column:
            size = F.length(one["sentence"])
            return F.translate(rest, "\n", " ").startswith(one["sentence"]) & rest.substr(
                size + 1, F.lit(1)
            ).isin("\n", "")

        def found(known: Column, text: Column) -> Column:
            return F.struct(known.alias("known"), F.size(F.split(text, "\n")).alias("n_lines"))

        parts = [
            F.transform(
                F.filter(table, whole),
                lambda one: found(one["known"], rest.substr(F.lit(1), F.length(one["sentence"]))),
            )
        ]
        name = rf"[^ \n]+(?:[ \n][^ \n]+){{0,{NAME_WORDS - 1}}}?"
        for known, sentence in open_ones.items():
            pattern = rf"^({sentence.replace(' ', '[ \n]').replace('*', name)})(?:\n|$)"
            text = F.regexp_extract(rest, pattern, 1)
            parts.append(F.when(text != "", F.array(found(F.lit(known), text))).otherwise(none))
        return F.concat(*parts)

    may_begin, may_begin_open = begins(sentences), begins(open_ones)

    def line(own: Column, sent: Column):
        return lambda x, k: F.struct(
            sent.alias("sent"),
            x.alias("text"),
            F.when(
                ((F.size(own) > k + 1) & F.substring_index(x, " ", 2).isin(may_begin))
                | F.substring_index(x, " ", 2).isin(may_begin_open),
                at(own, k),
            )
            .otherwise(none)
            .alias("wrapped"),
        )

    return F.flatten(F.transform(lines, lambda own, sent: F.transform(own, line(own, sent))))


def _within(few: list[str], many: list[str]) -> bool:
    """Whether the few are among the many in the same order."""
    rest = iter(many)
    return all(name in rest for name in few)


def scan(
    docs: DataFrame,
    sentences: dict[str, str] | None = None,
    rules: dict[str, tuple[str, list[str]]] | None = None,
    gap: int = GAP,
) -> DataFrame:
    """``(doc_id, n_sentences, n_known, n_matches, licenses)`` for every document.

    ``n_sentences`` counts lines and sentences. ``n_known`` counts known sentences, on one
    line or wrapped over several, ``n_matches`` the places where a whole rule matches, and
    ``licenses`` is the sorted array of licences found. The rules' next sentence is looked
    up at each of the next ``gap + 1`` lines and in each of the next ``gap + 1`` sentences,
    once a rule and place, so a document that repeats one sentence a million times costs
    so many million look-ups a rule and no more. Where rules of several licences begin in the
    same sentence and one holds all sentences of another and more, only the longer one counts.
    Sentences and rules are a fixed table, which bounds what is broadcast.

    Null and empty texts have no sentences. Null ids stay null, repeated rows give
    repeated results, an empty table gives none, and other columns are ignored.
    """
    spark = docs.sparkSession
    sentences = SENTENCES if sentences is None else sentences
    rules = RULES if rules is None else rules
    known = spark.createDataFrame(list(sentences.items()), "known string, sentence string")
    steps = spark.createDataFrame(
        [
            (rule, licence, k, name, len(names))
            for rule, (licence, names) in rules.items()
            for k, name in enumerate(names)
        ],
        "rule string, licence string, step int, wanted string, n_steps int",
    )
    lines = normal_lines(F.col("text"))
    cut = (
        docs.select(
            "doc_id",
            F.xxhash64("text").alias("doc_key"),
            wrapped_places(lines, sentences).alias("all"),
        )
        .select(
            "doc_id",
            "doc_key",
            F.coalesce(F.size("all"), F.lit(0)).alias("n_sentences"),
            F.posexplode_outer("all").alias("pos", "line"),
        )
        .select(
            "doc_id",
            "doc_key",
            "n_sentences",
            "pos",
            "line.sent",
            "line.wrapped",
            F.col("line.text").alias("sentence"),
        )
    )
    leads = F.coalesce(F.col("pos"), F.lit(0)) == 0
    seen = staged(
        cut.join(F.broadcast(known), "sentence", "left")
        .where(F.col("known").isNotNull() | (F.size("wrapped") > 0) | leads)
        .select(
            "doc_id", "doc_key", "n_sentences", "pos", "sent", "known", "wrapped", leads.alias("leads")
        ),
        "licence-sentences",
    )
    key = ["doc_id", "doc_key"]
    here = F.struct("known", F.lit(1).alias("n_lines"))
    whole = F.concat(F.array(here), F.coalesce("wrapped", F.array()))
    places = (
        seen.select(*key, "pos", "sent", F.explode(whole).alias("one"))
        .where("one.known is not null")
        .select(*key, "pos", (F.col("pos") + F.col("one.n_lines") - 1).alias("last"), "sent", "one.known")
        .distinct()
    )
    state = [*key, "start", "pos", "last", "sent", "rule", "licence", "n_steps"]
    first = F.broadcast(steps.where("step = 0"))
    open_rules = (
        places.withColumn("start", F.col("sent"))
        .join(first, F.col("known") == F.col("wanted"))
        .select(*state)
    )
    by_place = places.select(
        "*",
        F.explode(
            F.array(
                F.struct(F.lit("line").alias("of"), F.col("pos").alias("at")),
                F.struct(F.lit("sentence").alias("of"), F.col("sent").alias("at")),
            )
        ).alias("there"),
    )

    def next_places(kind: str, column: str) -> Column:
        ahead = F.sequence(F.col(column) + 1, F.col(column) + 1 + gap)
        return F.transform(ahead, lambda at: F.struct(F.lit(kind).alias("of"), at.alias("at")))

    complete = open_rules.where("n_steps = 1")
    for step in range(1, max((len(names) for _, names in rules.values()), default=1)):
        following = F.broadcast(
            steps.where(F.col("step") == step).select(F.col("rule").alias("_rule"), "wanted")
        )
        looking = (
            open_rules.join(following, F.col("rule") == F.col("_rule"))
            .select(
                F.col("doc_id").alias("_doc_id"),
                F.col("doc_key").alias("_doc_key"),
                "start",
                "rule",
                "licence",
                "n_steps",
                "wanted",
                F.explode(
                    F.concat(next_places("line", "last"), next_places("sentence", "sent"))
                ).alias("_there"),
            )
            .distinct()
        )
        open_rules = (
            looking.join(
                by_place,
                F.col("_doc_id").eqNullSafe(F.col("doc_id"))
                & (F.col("_doc_key") == F.col("doc_key"))
                & (F.col("_there") == F.col("there"))
                & (F.col("wanted") == F.col("known")),
            )
            .select(*state)
            .distinct()
        )
        complete = complete.unionByName(open_rules.where(F.col("n_steps") == step + 1))
    beaten = [
        (longer, shorter)
        for longer, (licence, names) in rules.items()
        for shorter, (other, few) in rules.items()
        if licence != other and len(few) < len(names) and few[0] == names[0] and _within(few, names)
    ]
    if beaten:
        complete = staged(complete, "licence-matches")
        losers = (
            complete.join(
                F.broadcast(spark.createDataFrame(beaten, "rule string, shorter string")), "rule"
            )
            .select(
                F.col("doc_id").alias("_doc_id"),
                F.col("doc_key").alias("_doc_key"),
                F.col("start").alias("_start"),
                "shorter",
            )
            .distinct()
        )
        complete = complete.join(
            losers,
            F.col("doc_id").eqNullSafe(F.col("_doc_id"))
            & (F.col("doc_key") == F.col("_doc_key"))
            & (F.col("start") == F.col("_start"))
            & (F.col("rule") == F.col("shorter")),
            "left_anti",
        )
    complete = complete.select(*key, "pos", "rule", "licence").distinct()
    found = (
        complete.groupBy(*key)
        .agg(F.count("*").alias("n_matches"), F.sort_array(F.collect_set("licence")).alias("licenses"))
        .select(
            F.col("doc_id").alias("_doc_id"), F.col("doc_key").alias("_doc_key"), "n_matches", "licenses"
        )
    )
    counted = places.groupBy(
        F.col("doc_id").alias("_known_id"), F.col("doc_key").alias("_known_key")
    ).agg(F.count("*").alias("n_known"))
    return (
        seen.where("leads")
        .select(*key, F.col("n_sentences").cast("long"))
        .join(
            counted,
            F.col("doc_id").eqNullSafe(F.col("_known_id")) & (F.col("doc_key") == F.col("_known_key")),
            "left",
        )
        .join(
            found,
            F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("doc_key") == F.col("_doc_key")),
            "left",
        )
        .select(
            "doc_id",
            "n_sentences",
            F.coalesce("n_known", F.lit(0)).alias("n_known"),
            F.coalesce("n_matches", F.lit(0)).alias("n_matches"),
            F.coalesce(F.col("licenses"), F.array().cast("array<string>")).alias("licenses"),
        )
    )
