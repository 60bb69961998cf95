"""License notices in texts, found by the places of their rarest words and verified by their key phrases."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import fresh

# what lies between words: ASCII other than letters and digits (capitals are lowered after the split)
_WORDS = "regexp_extract_all({text}, '([^\\\\x00-\\\\x2F\\\\x3A-\\\\x40\\\\x5B-\\\\x60\\\\x7B-\\\\x7F]+)', 1)"


@dataclass(frozen=True)
class Notice:
    """Words of a notice, and the phrases in it without which it is not that notice. `base` ones are phrases as such."""

    label: str
    text: str
    keys: tuple[str, ...]
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    def key_places(self) -> list[int]:
        """Positions of the key phrases' words in the notice."""
        places = set()
        for key in self.keys:
            part = key.split()
            first = next(i for i in range(len(self.words)) if self.words[i : i + len(part)] == part)
            places |= set(range(first, first + len(part)))
        return sorted(places)


def _phrase(label: str, text: str, base: bool = False) -> Notice:
    return Notice(label, text, (text,), base)


# fixed values: phrases and labels that the base counts
BASE = [
    _phrase("mit", "under the mit license", base=True),
    _phrase("apache-2", "apache license version 2", base=True),
    _phrase("cc-by-nc", "cc by nc", base=True),
]
# notices as their publishers word them, lower-case and without punctuation
NOTICES = BASE + [
    Notice(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        ("permission is hereby granted free of charge", "obtaining a copy of this software"),
    ),
    Notice(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
        ("apache license version 2 0",),
    ),
    Notice("apache-2", "you may obtain a copy of the license at http www apache org licenses license 2 0", ("apache org licenses license 2 0",)),
    Notice("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Notice("gpl-2", "under the terms of the gnu general public license version 2", ("gnu general public license version 2",)),
    _phrase("lgpl", "gnu lesser general public license"),
    _phrase("agpl", "gnu affero general public license"),
    Notice("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Notice(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms", "with or without modification"),
    ),
    Notice(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ("permission to use copy modify and or distribute this software",),
    ),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Notice("cc-by-nc-4", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    _phrase("cc-by-4", "cc by 4 0"),
    _phrase("cc-by-sa-4", "cc by sa 4 0"),
    _phrase("cc0", "cc0 1 0 universal"),
]


def _list(values: list[str]) -> str:
    return f"array({', '.join(values)})"


def _quoted(words: list[str]) -> list[str]:
    return [f"'{w}'" for w in words]


def _hits(words: str, vocabulary: list[str]) -> str:
    """The vocabulary's words among `words`, lower-case, with their places. What only turns into ASCII when lowered has more bytes before."""
    lowered = "octet_length(lower(x)) = octet_length(x) AND lower(x) IN ({})".format(", ".join(_quoted(vocabulary)))
    return f"filter(transform({words}, (x, i) -> IF({lowered}, struct(lower(x) AS word, i AS at), NULL)), x -> x IS NOT NULL)"


def rarity(df: DataFrame, text: str, notices: list[Notice] = NOTICES) -> dict[str, float]:
    """ln((1 + rows) / (1 + rows that hold it)) of every word of the notices, over all rows; as many values as the notices have words."""
    vocabulary = sorted({w for n in notices for w in n.words})
    words = df.select(F.expr(_WORDS.format(text=f"`{text}`")).alias("w"))
    hits = words.select(F.expr(f"array_distinct(transform({_hits('w', vocabulary)}, x -> x.word))").alias("h"))
    # one more row per task counts the rows, so that one pass does for both
    counted = hits.select(F.explode(F.concat(F.coalesce("h", F.array().cast("array<string>")), F.array(F.lit("")))).alias("word")).groupBy("word").count()
    rows = {r["word"]: r["count"] for r in counted.collect()}
    return {w: math.log((1 + rows.get("", 0)) / (1 + rows.get(w, 0))) for w in vocabulary}


def _index(notices: list[Notice], rare: dict[str, float]) -> str:
    """The notices as one array, each with the postings of its key phrases' words from the rarest to the most frequent."""

    def entry(n: Notice) -> str:
        keys = sorted(n.key_places(), key=lambda k: (-rare[n.words[k]], k))
        return (
            f"named_struct('label', '{n.label}', 'base', {str(n.base).lower()}, 'words', {_list(_quoted(n.words))}, "
            f"'rarity', {_list([f'{rare[w]!r}D' for w in n.words])}, "
            f"'keys', {_list([f'''named_struct('word', '{n.words[k]}', 'at', {k})''' for k in keys])})"
        )

    return _list([entry(n) for n in notices])


def find_licenses(
    df: DataFrame, text: str, found: str = "licenses", n_words: str = "n_words", notices: list[Notice] = NOTICES, rare: dict[str, float] | None = None
) -> DataFrame:
    """`df` with the number of words and the notices `found`: label, base, starts (word numbers, ascending), score.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII;
    A-Z are lowered, and no other letter is. A notice's postings are looked up in
    the order of their rarity over the whole of `df` (`rare` holds it if known):
    the places of the rarest key word in the text, less its place in the notice,
    are the first candidates, and every other key word's places, shifted alike, are
    intersected with them. What is left are the starts at which all key
    phrases stand whole. The score of a notice is the share, by rarity, of its
    words that stand at their place from one of its starts; 1 where no word has any rarity.

    A start may be negative where a text lacks the beginning of a notice. A NULL
    or empty text has no words and no notices. Repeated rows each get their own;
    columns named like the two outputs are replaced. Every step is linear in a
    text's length, whatever is repeated in it.
    """
    rows = df.drop(found, n_words)
    rare = rarity(rows, text, notices) if rare is None else rare
    vocabulary = sorted({w for n in notices for w in n.words})
    words, hits, matched = fresh(rows, "words"), fresh(rows, "hits"), fresh(rows, "matched")

    def shifted(word: str, at: str) -> str:
        return f"transform(filter({hits}, x -> x.word = {word}), x -> x.at - {at})"

    starts = f"aggregate(slice(t.keys, 2, size(t.keys)), {shifted('t.keys[0].word', 't.keys[0].at')}, (a, e) -> IF(size(a) = 0, a, array_intersect(a, {shifted('e.word', 'e.at')})))"
    matches = f"filter(transform({_index(notices, rare)}, t -> named_struct('t', t, 'starts', {starts})), m -> size(m.starts) > 0)"
    seen = f"IF(size(array_intersect(m.starts, {shifted('w', 'k')})) > 0, m.t.rarity[k], 0D)"
    score = f"coalesce(try_divide(aggregate(transform(m.t.words, (w, k) -> {seen}), 0D, (a, x) -> a + x), aggregate(m.t.rarity, 0D, (a, x) -> a + x)), 1D)"
    return (
        rows.withColumn(words, F.expr(_WORDS.format(text=f"coalesce(`{text}`, '')")))
        .withColumns({n_words: F.size(words).cast("bigint"), hits: F.expr(_hits(words, vocabulary))})
        .withColumn(matched, F.expr(matches))
        .withColumn(found, F.expr(f"transform({matched}, m -> named_struct('label', m.t.label, 'base', m.t.base, 'starts', m.starts, 'score', {score}))"))
        .select(*rows.columns, n_words, found)
    )


def summary(found: str = "licenses") -> dict[str, str]:
    """SQL for the columns that describe the notices of a text in short."""
    base = f"filter({found}, m -> m.base)"
    places = f"flatten(transform({base}, m -> m.starts))"

    def labels(of: str) -> str:
        return f"array_join(array_sort(array_distinct(transform({of}, m -> m.label))), ',')"

    return {
        "n_base": f"cast(size({places}) AS bigint)",
        "first_word": f"cast(array_min({places}) AS bigint)",
        "last_word": f"cast(array_max({places}) AS bigint)",
        "base_labels": labels(base),
        "labels": labels(found),
        "score": f"coalesce(round(array_max(transform({found}, m -> m.score)), 6), 0D)",
    }


def oracle(notices: list[Notice] = NOTICES) -> str:
    """The same by joins of single words with single words of the notices."""
    rows = [
        f"({t}, '{n.label}', {str(n.base).lower()}, {k}, '{w}', {str(k in n.key_places()).lower()})"
        for t, n in enumerate(notices)
        for k, w in enumerate(n.words)
    ]
    return rf"""
WITH notice(t, label, base, k, word, is_key) AS (VALUES {', '.join(rows)}),
text_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), word AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM text_words
), hit AS (
  SELECT * FROM word WHERE word IN (SELECT word FROM notice)
), rarity AS (
  SELECT v.word, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(DISTINCT hit.doc_id))) AS r
  FROM (SELECT DISTINCT word FROM notice) v LEFT JOIN hit ON hit.word = v.word GROUP BY v.word
), start AS (
  SELECT doc_id, t, any_value(label) AS label, any_value(base) AS base, pos - k AS first
  FROM hit JOIN notice USING (word) WHERE is_key
  GROUP BY doc_id, t, pos - k HAVING count(*) = (SELECT count(*) FROM notice n WHERE n.t = notice.t AND n.is_key)
), seen AS (
  SELECT DISTINCT start.doc_id, start.t, n.k, n.word
  FROM start JOIN notice n ON n.t = start.t JOIN hit ON hit.doc_id = start.doc_id AND hit.pos = start.first + n.k AND hit.word = n.word
), score AS (
  SELECT doc_id, t, sum(r) / (SELECT sum(r) FROM notice n JOIN rarity USING (word) WHERE n.t = seen.t) AS s
  FROM seen JOIN rarity USING (word) GROUP BY doc_id, t
), found AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM start GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(f.n_base, 0) AS n_base, CAST(f.first_word AS BIGINT) AS first_word,
       CAST(f.last_word AS BIGINT) AS last_word, coalesce(f.base_labels, '') AS base_labels, coalesce(f.labels, '') AS labels,
       coalesce(round((SELECT max(s) FROM score WHERE score.doc_id = d.doc_id), 6), 0.0) AS score
FROM text_words d LEFT JOIN found f ON f.doc_id = d.doc_id
"""
