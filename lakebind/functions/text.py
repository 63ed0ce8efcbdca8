"""Text functions as column expressions: folding, tokens, synonyms, spans, compaction, ids, paths."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that are no tokens (fixed values).
STOPWORDS = (
    "the", "and", "or", "of", "in", "on", "for", "to", "a", "an", "is", "are", "be", "what", "which", "how", "many",
    "with", "by", "from", "where", "did", "does", "do",
    "là", "của", "cho", "tôi", "hãy", "trong", "và", "các", "có", "nào", "gì", "bao", "nhiêu", "được", "với", "theo",
)

#: (groups of tokens of which one must be wholly there, tokens added) (fixed values).
SYNONYMS = (
    ((("hoc", "bong"),), ("scholarship",)),
    ((("hang", "khong"),), ("airline", "airlines", "aviation", "air")),
    ((("anh",), ("hinh",)), ("image", "photo", "picture", "jpg", "png")),
    ((("diem",), ("lop",), ("toan",)), ("grade", "grades", "class", "math")),
    ((("kinh", "te", "chinh", "tri"), ("xhcn",)), ("ktct", "political", "economy", "ktttrxhcn")),
    ((("thanh", "vien"), ("nhom",)), ("member", "members", "team", "ise")),
    ((("am", "thanh"), ("audio",), ("m4a",), ("mp3",), ("workshop",)), ("audio", "m4a", "meeting", "workshop")),
    ((("du", "an"),), ("project",)),
    ((("thu", "vien"),), ("library", "smart")),
    ((("lam", "sach"), ("song", "minh", "hoa")), ("river", "cleanup", "community")),
    ((("novacare",),), ("customer", "support", "startup", "ai")),
)

#: A token: a run of ASCII letters and digits, or one CJK character.
TOKEN = "[a-z0-9]+|[一-鿿]"
MARKS = "[̀-ͯ]"
#: Compatibility characters that stand for several letters.
LIGATURES = (("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("ﬃ", "ffi"), ("ﬄ", "ffl"))


def _folding() -> tuple[str, str]:
    """Accented letters in lower case and the ASCII letters they fold to, by decomposition."""
    pairs = {}
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        letter = chr(code).lower()
        plain = "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))
        if len(letter) == 1 and len(plain) == 1 and plain.isascii() and plain != letter:
            pairs[letter] = plain
    return "".join(pairs), "".join(pairs.values())


ACCENTED, PLAIN = _folding()


def lowered(text: Column) -> Column:
    """Lower case, ligatures taken apart; null is empty."""
    out = F.lower(F.coalesce(text, F.lit("")))
    for joined, letters in LIGATURES:
        out = F.replace(out, F.lit(joined), F.lit(letters))
    return out


def fold(text: Column) -> Column:
    """Lower case without accents. Letters that do not decompose (such as the barred d) stay."""
    return F.translate(F.regexp_replace(lowered(text), MARKS + "+", ""), ACCENTED, PLAIN)


def token_like(text: Column) -> Column:
    """What looks like a token in the lower-cased text, then in the folded text: a plain word comes twice."""
    composed = F.regexp_replace(lowered(text), f"[a-z]{MARKS}+", " ")
    return F.concat(F.regexp_extract_all(composed, F.lit(TOKEN), F.lit(0)), F.regexp_extract_all(fold(text), F.lit(TOKEN), F.lit(0)))


def is_token(word: Column) -> Column:
    return ((F.char_length(word) >= 2) | word.rlike("^[一-鿿]$")) & ~word.isin(*STOPWORDS)


def raw_tokens(text: Column) -> Column:
    """Tokens of the lower-cased text, then those of the folded text."""
    return F.filter(token_like(text), is_token)


#: Tokens that a rule of synonyms looks for.
TRIGGERS = tuple(sorted({word for groups, _ in SYNONYMS for group in groups for word in group}))


def synonyms(tokens: Column) -> Column:
    """The tokens that the rules add, sorted and distinct."""
    def holds(groups: tuple) -> Column:
        out = F.lit(False)
        for group in groups:
            out = out | (F.size(F.array_except(F.array(*map(F.lit, group)), tokens)) == 0)
        return out

    none = F.array().cast("array<string>")
    added = [F.when(holds(groups), F.array(*map(F.lit, words))).otherwise(none) for groups, words in SYNONYMS]
    return F.array_sort(F.array_distinct(F.flatten(F.array(*added))))


def with_tokens(df: DataFrame, text: Column, name: str = "tokens", expand: bool = True) -> DataFrame:
    """``df`` with the tokens of a text. The rules look at the tokens many times, so those are a column of their own."""
    plain = df.withColumn(name, raw_tokens(text))
    return plain.withColumn(name, F.concat(F.col(name), synonyms(F.col(name)))) if expand else plain


def collapse(text: Column) -> Column:
    """Runs of any white space as one blank, none at the ends; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


def compact(text: Column, limit: int = 1000) -> Column:
    """Collapsed text, cut to ``limit`` characters with three dots."""
    whole = collapse(text)
    return F.when(F.char_length(whole) <= limit, whole).otherwise(F.concat(F.rtrim(F.substring(whole, 1, limit - 3)), F.lit("...")))


def agent_truncate(text: Column, limit: int) -> Column:
    cut = F.regexp_replace(F.substring(text, 1, limit - 20), r"(?U)\s+$", "")
    return F.when(F.char_length(text) <= limit, text).otherwise(F.concat(cut, F.lit("\n[... truncated ...]")))


def quoted_spans(text: Column) -> Column:
    """Trimmed spans between double, curly or single quotes, in order, none empty."""
    spans = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("\"[^\"]+\"|“[^”]+”|'[^']+'"), F.lit(0))
    return F.filter(F.transform(spans, lambda s: F.trim(F.substring(s, F.lit(2), F.char_length(s) - 2))), lambda s: s != "")


def folder_spans(text: Column) -> Column:
    """Spans between double, single or back quotes, without slashes at the ends."""
    spans = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("\"[^\"]+\"|'[^']+'|`[^`]+`"), F.lit(0))
    inner = F.transform(spans, lambda s: F.regexp_replace(F.trim(F.substring(s, F.lit(2), F.char_length(s) - 2)), r"^[/\\]+|[/\\]+$", ""))
    return F.filter(F.transform(inner, lambda s: F.replace(s, F.lit("\\"), F.lit("/"))), lambda s: s != "")


def stable_id(*parts: Column, length: int = 24) -> Column:
    """The first characters of the SHA-1 of the parts joined by a double colon; null is empty."""
    joined = F.concat_ws("::", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.substring(F.sha1(joined), 1, length)


def text_hash(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def normal_path(path: Column) -> Column:
    """A path with forward slashes, without accents, in lower case."""
    return fold(F.replace(path, F.lit("\\"), F.lit("/")))


def compact_key(path: Column) -> Column:
    """Only the ASCII letters and digits of a normal path; different paths may have one key."""
    return F.regexp_replace(normal_path(path), "[^a-z0-9]+", "")


def glob_regex(pattern: Column) -> Column:
    """An anchored regular expression of a shell pattern: ``*`` crosses slashes, ``?`` is one character, sets stay."""
    escaped = F.regexp_replace(pattern, r"([.\\+^$(){}|])", r"\\$1")
    escaped = F.regexp_replace(escaped, r"\*+", ".*")
    return F.concat(F.lit("^(?s:"), F.regexp_replace(F.replace(escaped, F.lit("?"), F.lit(".")), r"\[!", "[^"), F.lit(")$"))


def is_placeholder(text: Column, parser: Column) -> Column:
    """Whether a text only says that a file was not read."""
    head = F.lower(F.substring(F.regexp_replace(F.coalesce(text, F.lit("")), r"^(?U)\s+", ""), 1, 300))
    return F.contains(F.lower(F.coalesce(parser, F.lit(""))), F.lit("placeholder")) | head.rlike("available at|is disabled|not implemented|did not produce text")


def source_kind(path: Column) -> Column:
    """The kind of a file in the lexical corpus, by its extension."""
    extension = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    return (
        F.when(extension.isin(".csv", ".xlsx", ".xls", ".sql"), "table")
        .when(extension.isin(".png", ".jpg", ".jpeg", ".webp", ".gif", ".bmp", ".tif", ".tiff"), "image")
        .when(extension.isin(".m4a", ".mp3", ".wav", ".flac", ".ogg"), "audio")
        .when(extension.isin(".pdf", ".docx", ".pptx", ".ppt", ".txt", ".md", ".html", ".htm", ".xml", ".json", ".jsonl"), "document")
        .otherwise("file")
    )


def expansion_kind(path: Column) -> Column:
    """The kind of a file that folder expansion adds, by its extension: another mapping."""
    extension = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    return (
        F.when(extension.isin(".jpg", ".jpeg", ".png", ".webp", ".gif", ".bmp"), "image")
        .when(extension.isin(".csv", ".xlsx", ".xls", ".sql", ".db", ".sqlite", ".json"), "table")
        .when(extension.isin(".m4a", ".mp3", ".wav", ".flac"), "audio")
        .otherwise("text")
    )


def route(path: Column) -> Column:
    """Which reader takes a file, by its extension."""
    extension = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    return (
        F.when(extension.isin(".txt", ".md", ".html", ".htm", ".xml", ".json", ".jsonl", ".yaml", ".yml", ".docx"), "text")
        .when(extension.isin(".pdf", ".pptx", ".ppt"), "document")
        .when(extension.isin(".png", ".jpg", ".jpeg", ".webp", ".gif", ".bmp", ".tif", ".tiff"), "image")
        .when(extension.isin(".m4a", ".mp3", ".wav", ".flac", ".ogg"), "audio")
        .when(extension.isin(".csv", ".tsv", ".xlsx", ".xls", ".sql", ".db", ".sqlite", ".sqlite3", ".duckdb", ".parquet"), "table")
        .otherwise("other")
    )


# The same expressions in DuckDB's SQL, from the same fixed values.

def sql_list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def sql_lowered(text: str) -> str:
    out = f"lower(coalesce({text}, ''))"
    for joined, letters in LIGATURES:
        out = f"replace({out}, '{joined}', '{letters}')"
    return out


def sql_fold(text: str) -> str:
    return f"translate(regexp_replace({sql_lowered(text)}, '{MARKS}+', '', 'g'), '{ACCENTED}', '{PLAIN}')"


def sql_raw_tokens(text: str) -> str:
    composed = f"regexp_replace({sql_lowered(text)}, '[a-z]{MARKS}+', ' ', 'g')"
    both = f"list_concat(regexp_extract_all({composed}, '{TOKEN}'), regexp_extract_all({sql_fold(text)}, '{TOKEN}'))"
    return f"list_filter({both}, lambda t: (length(t) >= 2 OR regexp_full_match(t, '[一-鿿]')) AND NOT list_contains({sql_list(STOPWORDS)}, t))"


def sql_synonyms(tokens: str) -> str:
    rules = []
    for groups, words in SYNONYMS:
        holds = " OR ".join(f"list_has_all({tokens}, {sql_list(g)})" for g in groups)
        rules.append(f"CASE WHEN {holds} THEN {sql_list(words)} ELSE []::VARCHAR[] END")
    return f"list_sort(list_distinct(flatten([{', '.join(rules)}])))"


def sql_collapse(text: str) -> str:
    return f"trim(regexp_replace(coalesce({text}, ''), '[\\s\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}\\x0b]+', ' ', 'g'))"


def sql_compact(text: str, limit: int) -> str:
    whole = sql_collapse(text)
    return f"CASE WHEN length({whole}) <= {limit} THEN {whole} ELSE rtrim(substring({whole}, 1, {limit - 3})) || '...' END"
