"""Quality rules, line first: each line is judged on its own, failing lines go, and a document that loses too much goes.

Base counts over the whole text come along: characters in words, symbols, repeated lines, and words inside 8-word windows
that the text holds twice or more. Words are runs of bytes other than x20 and x09 to x0D; lines are parted by x0A. One pass
over the texts; nothing is shuffled.

A line with words fails as
  symbols      if it has at least one of #*$%&|<> for each ten characters of its words (tables, menus, junk),
  shouting     if it has three words or more and over three times as many letters A-Z as a-z,
  repetition   if it has twelve words or more and at most a quarter of them are distinct,
  boilerplate  if it holds a phrase of web pages' furniture, or such words that weigh as much as all its words,
  links        if at least half of its words are addresses,
  menu         if at least a quarter of its words, two or more, are separators and it doesn't end as a sentence,
  counter      if it has up to eight words, at least half of them numbers, dates or times, and doesn't end as a sentence,
  navigation   if it has one to three words and doesn't end in punctuation (a heading or a menu entry),
  unfinished   if it has four to twelve words, doesn't end in punctuation, and the next line with words doesn't go on in lower
               case (teasers, list entries; wrapped prose and longer paragraphs that break off pass).

The first rule that holds names the line. Furniture is known in English, German, French and Spanish: a phrase that hardly stands in prose
is enough, a word that may stand there weighs LIGHT words. Only A-Z are lower-cased for it. A line that other documents hold, too, isn't
judged by that: copies of a clean document are clean.

Defined results: a null text is like an empty one: no words, base_failed, not kept, cleaned text ''. A null doc_id
passes through; repeated rows give repeated results. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm._hashing import mix, words
from ledgerline.llm._spark import chunks, map_arrow, texts_of

LEAST_WORDS, WINDOW, MOST_REPEATED = 20, 8, 30
#: A document is rejected if fewer than so many percent of its words stand in lines that pass.
LEAST_LEFT = 50
SYMBOLS = b"#*$%&|<>"
LIGHT = 2
FURNITURE = "|".join((
    "cookie policy|privacy policy|terms of use|terms of service|all rights reserved|enable javascript|lorem ipsum|click here|skip to content|skip to main content|subscribe to our|sign up for|log in to",
    "cookie-richtlinie|datenschutzerklärung|nutzungsbedingungen|alle rechte vorbehalten|javascript aktivieren|hier klicken|zum inhalt springen|newsletter abonnieren|jetzt anmelden|zurück zur startseite",
    "politique de confidentialité|politique de cookies|conditions d'utilisation|mentions légales|tous droits réservés|activer javascript|cliquez ici|aller au contenu|abonnez-vous à|retour à l'accueil",
    "política de privacidad|política de cookies|condiciones de uso|aviso legal|todos los derechos reservados|activar javascript|haga clic aquí|haz clic aquí|saltar al contenido|suscríbete a|volver al inicio",
))
WORDS = r"\b(?:" + "|".join((
    "home|login|logout|register|sitemap|cookies|newsletter|subscribe|share|tweet|copyright|contact us|about us|read more|next page|previous page|faq",
    "startseite|impressum|anmelden|registrieren|kontakt|teilen|weiterlesen|warenkorb",
    "accueil|connexion|partager|lire la suite|plan du site|panier",
    "inicio|iniciar|contacto|compartir|leer m|mapa del sitio|carrito",
)) + r")\b"
ADDRESS = r"^https?://|^www[.]|@.*[.]"
NUMBER = r"^[0-9():/.,#+-]*[0-9][0-9():/.,#+-]*$"
SEPARATORS = ("|", "»", "›", ">", "·", "•", "/", "–", "-", "::")
#: Words of a counter's line, and of an unfinished one.
COUNTER, UNFINISHED = 8, 12
_FURNITURE, _WORDS, _ADDRESS, _NUMBER = (re.compile(x.encode()) for x in (FURNITURE, WORDS, ADDRESS, NUMBER))
_SEPARATORS = {x.encode() for x in SEPARATORS}
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
#: Bytes that end a sentence, and bytes that may end a line of prose.
STOPS = b".!?"
ENDS = b".!?:;,\"')]}"
_SPACE = b" \t\r\x0b\x0c"


def failing(line: bytes, goes_on: bool = False) -> str | None:
    """The name of the rule under which a line fails, '' for a line without words, None if it passes. goes_on: the next line begins in lower case."""
    parts = line.split()
    n = len(parts)
    if not n:
        return ""
    chars = sum(len(p) for p in parts) - (0 if line.isascii() else sum(0x80 <= c < 0xC0 for c in line))
    if 10 * (len(line) - len(line.translate(None, SYMBOLS))) >= chars:
        return "symbols"
    if n >= 3 and len(line) - len(line.translate(None, _UPPER)) > 3 * (len(line) - len(line.translate(None, _LOWER))):
        return "shouting"
    if n >= 12 and 4 * len(set(parts)) <= n:
        return "repetition"
    low, last = line.lower(), parts[-1][-1]
    if _FURNITURE.search(low) or LIGHT * len(_WORDS.findall(low)) >= n:
        return "boilerplate"
    if 2 * sum(_ADDRESS.search(p) is not None for p in low.split()) >= n:
        return "links"
    if last not in STOPS:
        between = sum(p in _SEPARATORS for p in parts)
        if between >= 2 and 4 * between >= n:
            return "menu"
        if n <= COUNTER and 2 * sum(_NUMBER.search(p) is not None for p in parts) >= n:
            return "counter"
    if n <= 3 and last not in ENDS:
        return "navigation"
    if 3 < n <= UNFINISHED and last < 0x80 and last not in ENDS and not goes_on:
        return "unfinished"
    return None


def judged(text: bytes) -> list[tuple[bytes, str | None]]:
    """The lines with words, each with the name of the rule under which it fails."""
    lines = [x for x in text.split(b"\n") if x.strip(_SPACE)]
    lower = [0x61 <= x.lstrip(_SPACE)[0] <= 0x7A for x in lines]
    return [(x, failing(x, goes_on)) for x, goes_on in zip(lines, [*lower[1:], False], strict=False)]


def repeated_words(hashes: np.ndarray, owner: np.ndarray, n_texts: int, window: int = WINDOW) -> np.ndarray:
    """Of each text, the words inside windows that it holds twice or more."""
    if len(hashes) < window:
        return np.zeros(n_texts, np.int64)
    n = len(hashes) - window + 1
    inside = np.flatnonzero(owner[:n] == owner[window - 1 :])
    acc = mix(hashes[:n] ^ mix(owner[:n].astype(np.uint64)))
    for j in range(1, window):
        acc = mix(acc ^ hashes[j : j + n])
    codes, _ = pd.factorize(acc[inside])
    twice = inside[np.bincount(codes, minlength=1)[codes] > 1] if len(inside) else inside
    step = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(step, twice, 1)
    np.add.at(step, twice + window, -1)
    return np.bincount(owner, np.cumsum(step)[:-1] > 0, minlength=n_texts).astype(np.int64)


def _judge(with_text: bool):
    def run(batches):
        for batch in chunks(batches):
            texts = texts_of(batch)
            hashes, starts, ends, owner = words(texts)
            n = np.bincount(owner, minlength=len(texts))
            repeated = repeated_words(hashes, owner, len(texts))
            raw = np.frombuffer(b" ".join([b"", *texts, b""]), dtype=np.uint8)
            inner = np.concatenate(([0], np.cumsum((raw & 0xC0) == 0x80)))
            chars = np.bincount(owner, ends - starts - (inner[ends] - inner[starts]), minlength=len(texts)).astype(np.int64)
            rows = []
            for t, text in enumerate(texts):
                passed, failed, filled, seen = [], set(), 0, set()
                for line, rule in judged(text):
                    filled += 1
                    seen.add(line)
                    if rule is None:
                        passed.append(line)
                    else:
                        failed.add(rule)
                left = sum(len(x.split()) for x in passed)
                bad = bool(n[t] < LEAST_WORDS or 100 * repeated[t] > MOST_REPEATED * n[t])
                rows.append((len(text) - len(text.translate(None, SYMBOLS)), filled - len(seen), bad, not bad and 100 * left >= LEAST_LEFT * n[t], left, ",".join(sorted(failed)), b"\n".join(passed)))
            cols = list(zip(*rows, strict=True))
            arrays = [batch.column(0), pa.array(n), pa.array(chars), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(repeated), pa.array(cols[2]), pa.array([bool(x) for x in cols[3]]), pa.array(cols[4], pa.int64()), pa.array(cols[5])]
            names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "left_words", "failed_rules"]
            if with_text:
                arrays, names = [*arrays, pa.array(cols[6], pa.binary()).cast(pa.string())], [*names, "cleaned"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def line_rules(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """For each row of docs its base counts, kept, the words left, the rules that lines failed, and the cleaned text."""
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, left_words long, failed_rules string"
    return map_arrow(docs.select("doc_id", "text"), _judge(with_text), schema + ", cleaned string" * with_text)


def _quoted(text: str) -> str:
    return text.replace("'", "''")


_W = r"[^\x20\x09-\x0D]+"
#: The same in DuckDB.
SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '{_W}') AS ws FROM d),
pos AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i, len(ws) AS n FROM w),
g AS (SELECT doc_id, i, n, CASE WHEN i + 8 <= n THEN list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) END AS gram FROM pos),
c AS (SELECT doc_id, i, gram IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, gram) > 1 AS twice FROM g),
cov AS (SELECT doc_id, max(twice::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS hit FROM c),
rep AS (SELECT doc_id, sum(hit) AS n_repeat FROM cov GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS place FROM d),
lw AS (SELECT doc_id, line, place, regexp_extract_all(line, '{_W}') AS ws FROM lines),
lf AS (SELECT doc_id, line, ws, len(ws) AS n, list_sum(list_transform(ws, lambda x: length(x))) AS chars, right(ws[-1], 1) AS last,
  translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
  coalesce(regexp_matches(lead(ws[1]) OVER (PARTITION BY doc_id ORDER BY place), '^[a-z]'), false) AS goes_on FROM lw WHERE len(ws) > 0),
lj AS (SELECT doc_id, line, n, CASE
  WHEN 10 * len(regexp_extract_all(line, '[#*$%&|<>]')) >= chars THEN 'symbols'
  WHEN n >= 3 AND len(regexp_extract_all(line, '[A-Z]')) > 3 * len(regexp_extract_all(line, '[a-z]')) THEN 'shouting'
  WHEN n >= 12 AND 4 * len(list_distinct(ws)) <= n THEN 'repetition'
  WHEN regexp_matches(low, '{_quoted(FURNITURE)}') OR {LIGHT} * len(regexp_extract_all(low, '{WORDS}')) >= n THEN 'boilerplate'
  WHEN 2 * len(list_filter(regexp_extract_all(low, '{_W}'), lambda x: regexp_matches(x, '{ADDRESS}'))) >= n THEN 'links'
  WHEN NOT contains('.!?', last) AND len(list_filter(ws, lambda x: x IN {SEPARATORS})) >= greatest(2, n / 4) THEN 'menu'
  WHEN NOT contains('.!?', last) AND n <= {COUNTER} AND 2 * len(list_filter(ws, lambda x: regexp_matches(x, '{NUMBER}'))) >= n THEN 'counter'
  WHEN n <= 3 AND NOT contains('.!?:;,"'')]}}', last) THEN 'navigation'
  WHEN n BETWEEN 4 AND {UNFINISHED} AND unicode(last) < 128 AND NOT contains('.!?:;,"'')]}}', last) AND NOT goes_on THEN 'unfinished' END AS rule FROM lf),
la AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup, coalesce(sum(CASE WHEN rule IS NULL THEN n END), 0) AS passed, string_agg(DISTINCT rule, ',' ORDER BY rule) AS failed FROM lj GROUP BY doc_id),
a AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
  coalesce(dup, 0) AS dup, coalesce(n_repeat, 0) AS n_repeat, coalesce(passed, 0) AS passed, coalesce(failed, '') AS failed
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN la USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, dup::BIGINT AS n_dup_lines, n_repeat::BIGINT AS n_repeat_words,
  n_words < 20 OR 100 * n_repeat > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat > 30 * n_words) AND 100 * passed >= 50 * n_words AS kept, passed::BIGINT AS left_words, failed AS failed_rules FROM a
"""
