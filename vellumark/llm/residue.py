"""Template residue, filler, error pages and script notices among documents (problem 10).

Lines are normalised and counted by host over distinct texts; lines a host repeats are its boilerplate and
are subtracted from each record. The residual is searched for evidence: unfilled placeholders and running
filler count wherever they are left; error messages, short filler and notices that scripts are required count
where the residual holds no content beside them, so that texts which talk about such things stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut, spread
from .forms import fold, slices

#: A line is boilerplate of a host when such a share of its distinct texts hold it ...
RECURRENT_SHARE = 0.02
#: ... and at least so many, so that the few texts of a small host make none.
RECURRENT_TEXTS = 5
#: A line of short filler is no longer, ...
FILLER_CHARS = 80
#: ... and a sentence of a message no longer than this; longer ones talk about it.
MESSAGE_CHARS = 100
#: Letters and digits of content beside a message up to which the record is the message.
LEFT_CHARS = 60

# Notations of unfilled fields. `word` is a field's name in lower case, `Word` in capitals.
_word, _Word, _any = r"[a-z][a-z0-9]*(?:[_ .\-][a-z0-9]+){0,3}", r"[A-Z][A-Z0-9]*(?:_[A-Z0-9]+){0,3}", r"[\p{L}][\p{L}\p{N}_ .\-]{0,30}"
_insert = r"insert|enter|add|type|put|your|fill in|einfügen|eintragen|einsetzen|ausfüllen|hier|insertar?|poner|rellenar|escrib[aei]\w*|completar|insérer|saisir|compléter|remplir|indiquer|вставьте|введите|укажите|заполните|inserire|inserir"
PLACEHOLDER = regex.compile(
    rf"\{{\{{\s?{_any}\s?\}}\}}|\{{%\s?(?!(?:if|for|end\w*|else|block|set|include|extends)\b){_word}\s?%\}}|<%=?\s?{_word}\s?%>|&lt;%=?\s?{_word}\s?%&gt;"
    rf"|(?<![\w$#]){{{_word}}}(?!\w)|\$\{{{_word}\}}|#\{{{_word}\}}|(?<![\w\]\)])\[\[\s?{_word}\s?\]\]|<<\s?{_word}\s?>>|@@{_word}@@|%%{_Word}%%|«\s?{_Word}\s?»|\*\|{_Word}\|\*|(?<!\w)__{_Word}__(?!\w)"
    rf"|X{{3,}}_{_Word}_X{{3,}}|\[(?i:(?:{_insert})\b[^\[\]\n]{{1,30}}|[^\[\]\n]{{2,30}}\b(?:to be added|to be filled in|goes here|à compléter|einfügen|eintragen|aquí|ici|hier))\]|\((?i:fill in|insert|enter|tbd:?)\s[a-z][a-z ]{{1,28}}\)"
    rf"|【[^【】\n]{{1,16}}(?:を入力|を記入|をここに)】|<(?:Betreff|Name|Vorname|Anrede|Datum|Firma|Ort|Nombre|Apellido|Fecha|Asunto|Prénom|Nom|Objet|Subject|Date|Company|Recipient|Имя|Дата)>"
)
# Where such notation is code or is talked about.
QUOTED = regex.compile(r"```.*?```|`[^`\n]{1,200}`", regex.DOTALL)
CODE_LINE = regex.compile(
    r"^\s*(?:#!|#include|import |from \S+ import |def |class |return\b|for .*(?:\bin\b|;)|while |if .*[:{]\s*$|else\b|elif |try:|except\b|const |let |var |function\b|public |private |fn |SELECT\b|FROM\b|WHERE\b|GROUP BY|ORDER BY|INSERT INTO|UPDATE |set -|done$|fi$|do$|echo |export |\}|\{$|[\w.\[\]]+ ?[+\-*]?= ?\S|[\w.]+\(.*\);?$|<\?php|\$\w+ ?=|@\w+\(|//|/\*)"
)

# Messages of error pages, in several languages.
ERROR = regex.compile(
    r"\b[45]\d\d\b.{0,40}(?:not found|forbidden|bad gateway|error|unavailable|unauthori[sz]ed|denied|time-?out|too many|nicht gefunden|verboten|introuvable|interdit|no se encontr|prohibido|не найден|запрещ|ページ|見つかり)"
    r"|(?:error|erreur|fehler|ошибка|エラー|http|status|code|código|код)\W{0,3}[45]\d\d\b"
    r"|internal server error|bad gateway|service (?:is )?(?:temporarily )?unavailable|upstream unavailable|gateway time-?out|page (?:was )?not found|page isn.t (?:available|working)|could not be found on|requested (?:url|page).{0,40}(?:not|cannot)|access (?:is )?denied|permission (?:to (?:view|access)|denied)"
    r"|session (?:has )?(?:expired|timed out)|too many requests|something went wrong|(?:establishing|connecting to) (?:a |the )?database|can.t be reached|took too long to respond|checking (?:that you are human|if the site|your browser)|are you human|verify (?:that )?you are|no longer (?:exists|available)|has moved or|under maintenance|unexpected (?:condition|error)|an error (?:has )?occurred"
    r"|seite (?:existiert|wurde|konnte|ist) nicht|zugriff verweigert|serverfehler|sitzung ist abgelaufen|nicht verfügbar|vorübergehend nicht|datenbankverbindung|zu viele anfragen|ein fehler ist"
    r"|accès (?:refusé|interdit)|page introuvable|momentanément indisponible|n.existe plus|session (?:a )?expiré|erreur interne|trop de requêtes|une erreur"
    r"|acceso denegado|servicio no disponible|no disponible|sesión ha caducado|página no (?:existe|encontrada|disponible)|error interno|demasiadas solicitudes|ha ocurrido un error"
    r"|страница не найдена|доступ (?:запрещ|закрыт)|временно недоступ|сессия истекла|внутренняя ошибка|слишком много запросов|произошла ошибка"
    r"|見つかりません|アクセスが集中|しばらくしてから|権限がありません|セッションの有効期限|エラーが発生|メンテナンス中|利用できません"
    r"|traceback \(most recent call last\)|exception in thread|fatal error|\{\s?.error.\s?:|segmentation fault"
)
# Lines that only come with such a message.
DETAIL = regex.compile(
    r"^(?:\s*file .{1,120}, line \d+.*|\s*at [\w.$<>]+\(.*\)|\w*(?:error|exception|warning)\b:.*|(?:reference|request id|ray|ref|réf|incident|error id|vorgang|код|code|трейс|trace)\b.{0,3}[#:]?\s?[\w\-]{4,}\.?|[\w.\-]+/\d[\d.]*|please (?:try|log|sign|wait|check|contact|reload|return|go back|click).{0,80}|.{0,60}(?:try again|and (?:retry|reload)|later)\.?"
    r"|turn (?:them|it) on.{0,60}|if nothing happens.{0,80}|loading(?:…|\.\.\.)?|nginx.{0,20}|apache.{0,40}|bitte .{0,60}|veuillez .{0,60}|inténtelo .{0,40}|.{0,40}(?:позже|попробуйте).{0,40})$"
)
# Notices that scripts are required, in several languages.
SCRIPT = regex.compile(
    r"(?:enable|activate|allow|turn on|switch on|requires?|needs?|activer|activez|active|activar|habilit\w+|aktivier\w+|einschalten|включит\w+|разрешите).{0,40}(?:java ?script|\bscripts?\b|scripting|скрипт)"
    r"|(?:java ?script|\bscripts?\b|scripting).{0,60}(?:enable|disabled|required|turned off|switched off|not supported|allowed|désactivé|activé|requis|deaktiviert|aktivier|eingeschaltet|erforderlich|desactivado|activado|necesario|отключ|включ|有効|無効|必要)"
    r"|(?:does ?n.t|does not|will not|won.t|cannot|can.t) (?:support|work|run|function|load).{0,40}(?:java ?script|scripting|scripts?\b)|java ?script.{0,40}(?:will not|won.t|doesn.t) work|<noscript"
)
# Sentences that stand in for text, in several languages.
FILLER = regex.compile(
    r"^(?:sub-?)?headline$|blindtext|platzhaltertext|beispieltext|texto de (?:relleno|ejemplo|muestra)|texte de (?:remplissage|remplacement|substitution)|faux texte|(?:dummy|sample|placeholder|filler|example) (?:text|paragraph|content|copy)|replace before publishing|(?:your |some )?(?:text|content|copy|description|title|heading) (?:goes )?here\b|body copy|(?:description|heading|title|paragraph|item|text) \d+$|coming soon|under construction|loading(?:…|\.\.\.)|to be written"
    r"|testo segnaposto|texto simulado|текст-?заполнитель|рыбный текст|здесь (?:будет|должен быть) текст|ダミー(?:テキスト|文)|ここに(?:テキスト|文章|本文)|サンプルテキスト|準備中|文章が入ります|скоро (?:будет|здесь)|bald verfügbar|próximamente|bientôt"
)
MASHED = regex.compile(r"^(?:(?:asdf|qwer|qwerty|qwertz|azerty|jkl|hjkl|sdf|zxcv|yxcv|foo|bar|baz|xxx+|bla|blah|test|lorem|ipsum|abc|123|фыва|йцук|тест|テスト|あああ+)[\s,.!;:]*){2,}$")
# The stock passage of pseudo-Latin that filler is drawn from.
STOCK = (
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua ut enim ad minim veniam quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat "
    "duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt in culpa qui officia deserunt mollit anim id est laborum"
)
STEMS = frozenset(w[:4] for w in STOCK.split() if len(w) >= 4) | frozenset(("dola", "quam", "amen", "como"))
SENTENCE = regex.compile(r"[^.!?。！？\n]+[.!?。！？]?")
TAG = regex.compile(r"<(?:head|title|script|style)\b.*?</(?:head|title|script|style)>|</?(?:p|div|br|li|ul|h\d|tr|td|html|body|article|section|span|a|b|i|em|strong|table|footer|header|nav|noscript)\b[^<>]*>", regex.IGNORECASE | regex.DOTALL)
FOOTER = regex.compile(r"^(?:©|\(c\)|copyright).{0,60}$")


# A message or a line of short filler has one of these, or a status code beside the first; texts without them aren't searched for it.
STATUS_NEEDS = (
    "not found|forbidden|bad gateway|error|unavailable|unauthori|denied|timeout|time-out|too many|nicht gefunden|verboten|introuvable|interdit|no se encontr|prohibido|не найден|запрещ|ページ|見つかり|erreur|fehler|ошибка|エラー|http|status|code|código|код"
).split("|")
ERROR_NEEDS = (
    "not found|forbidden|bad gateway|internal server error|unavailable|gateway time|page isn|be found on|requested |denied|permission |expired|timed out|too many requests|something went wrong| database|be reached|took too long|checking |are you human|verify |no longer |moved or|under maintenance|unexpected |occurred"
    "|seite |zugriff verweigert|serverfehler|sitzung ist|nicht verfügbar|vorübergehend nicht|datenbankverbindung|zu viele anfragen|ein fehler ist|accès |introuvable|momentanément|existe plus|expiré|erreur interne|trop de requêtes|une erreur|acceso denegado|no disponible|sesión ha|página no|error interno|demasiadas|ha ocurrido"
    "|не найдена|доступ |временно недоступ|сессия истекла|внутренняя ошибка|слишком много|произошла ошибка|見つかりません|アクセスが集中|しばらくしてから|権限がありません|セッションの有効期限|エラーが発生|メンテナンス中|利用できません|traceback (|exception in thread|fatal error|error\":|error':|error\" :|error' :|segmentation fault"
).split("|")
SCRIPT_NEEDS = ("script", "скрипт")
FILLER_NEEDS = (
    "headline|blindtext|platzhaltertext|beispieltext|texto de |texte de |faux texte|dummy|sample|placeholder|filler|example|replace before| here|body copy|description |heading |title |paragraph |item |text |coming soon|under construction|loading|to be written"
    "|testo segnaposto|texto simulado|заполнитель|рыбный|здесь |ダミー|ここに|サンプルテキスト|準備中|文章が入ります|скоро |bald verfügbar|próximamente|bientôt"
).split("|")
STATUS = re.compile(r"(?<!\d)[45]\d\d(?!\d)")
LINE_ENDS = re.compile("[\n\r\x0b\x0c\u2028\u2029]")
DIGITS = re.compile(r"\d+")


def is_code(text: str) -> bool:
    """Whether most of a text's lines are code."""
    lines = [x for x in text.split("\n") if x.strip()]
    return len(lines) >= 3 and sum(bool(CODE_LINE.search(x)) for x in lines) >= 0.4 * len(lines)


def has_running_filler(paragraph: str) -> bool:
    """Two sentences' worth of pseudo-Latin: a passage of words nearly all of which begin like the stock passage."""
    words = paragraph.lower().split()
    if len(words) < 6 or (like := sum(w[:4] in STEMS for w in words)) < 4:
        return False
    if like >= 0.5 * len(words):
        return True
    for sentence in SENTENCE.findall(paragraph):
        words = sentence.lower().split()
        if len(words) >= 6 and sum(w[:4] in STEMS for w in words) >= 0.6 * len(words):
            return True
    return False


def shown_lines(text: str) -> list[str]:
    """The lines of a text without markup, white space as one space; a tag that holds a placeholder stays."""
    if "<" in text:
        text = TAG.sub(lambda m: " <noscript>\n" if m[0].lower().startswith("<noscript") else f"\n{m[0]}\n" if PLACEHOLDER.search(m[0]) else "\n", text)
    lines = (" ".join(x.split()) for x in LINE_ENDS.split(text))
    return [x for x in lines if x]


def line_key(line: str) -> int:
    """What lines are counted by: 64 bits of a line in lower case with its numbers as 0."""
    return int.from_bytes(blake2b(DIGITS.sub("0", line.casefold()).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def is_message(line: str) -> bool:
    """A line that is an error message or script notice: short sentences only, the first of which says so."""
    if len(line) > 3 * MESSAGE_CHARS or not (ERROR.search(line) or SCRIPT.search(line)):
        return False
    if len(line) <= MESSAGE_CHARS or line[0] in "{[<":
        return True
    sentences = [s for s in SENTENCE.findall(line) if s.strip()]
    return max(map(len, sentences)) <= MESSAGE_CHARS and bool(ERROR.search(sentences[0]) or SCRIPT.search(sentences[0]))


def examine(text: str) -> tuple[list[int], list[int], bool, list[tuple[int, int]]]:
    """(keys of all lines, keys of lines with evidence that counts anywhere, whether there is a message, (key, size) of the content beside it).

    Evidence is read line by line, as a line is what the boilerplate takes away; whether a record is code, and
    what it quotes as code, is told from the whole of it.
    """
    lines = shown_lines(text)
    keys = [line_key(x) for x in lines]
    anywhere = [k for x, k in zip(lines, keys, strict=True) if has_running_filler(x)]
    if any(c in text for c in "{}[]<>%@#«*_【;(") and PLACEHOLDER.search(text):
        bare = shown_lines(QUOTED.sub(" ", text)) if "`" in text else lines
        held = [line_key(x) for x in bare if PLACEHOLDER.search(x)]
        anywhere += [] if held and is_code(text) else held
    low = [x.casefold() for x in lines]
    said = "\n".join([x for x in low if len(x) <= 3 * MESSAGE_CHARS])
    may_say = any(w in said for w in SCRIPT_NEEDS) or any(w in said for w in ERROR_NEEDS) or STATUS.search(said) and any(w in said for w in STATUS_NEEDS)
    short = "\n".join([x for x in low if len(x) <= FILLER_CHARS])
    may_fill = short and any(w in short for w in FILLER_NEEDS)
    rest, message = [], False
    for line, key in zip(low, keys, strict=True):
        if may_say and is_message(line) or MASHED.search(line) or may_fill and len(line) <= FILLER_CHARS and FILLER.search(line):
            message = True
        else:
            rest.append((line, key))
    beside = [(k, sum(map(str.isalnum, x))) for x, k in rest if not DETAIL.search(x) and not FOOTER.search(x)] if message else []
    return keys, anywhere, message, beside


def _judged(df: DataFrame, key: str, text: str, host: str) -> DataFrame:
    narrow = df.select(F.col(key).alias("__key"), F.coalesce(F.col(host), F.lit("")).alias("__host"), F.col(text).alias("__text"), F.unhex(F.sha2(F.col(text), 256)).alias("digest"))
    keys = T.ArrayType(T.LongType(), False)
    beside = T.ArrayType(T.StructType([T.StructField("line", T.LongType(), False), T.StructField("size", T.IntegerType(), False)]), False)
    schema = T.StructType([*(narrow.schema[c] for c in ("__key", "__host", "digest")), T.StructField("lines", keys, False), T.StructField("anywhere", keys, False), T.StructField("message", T.BooleanType(), False), T.StructField("beside", beside, False)])
    sized = pa.list_(pa.struct([("line", pa.int64()), ("size", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            found = [examine(v) for v in fold(batch.column(2)).strings().to_pylist()]
            columns = [
                pa.array([sorted(set(f[0])) for f in found], pa.list_(pa.int64())),
                pa.array([sorted(set(f[1])) for f in found], pa.list_(pa.int64())),
                pa.array([f[2] for f in found], pa.bool_()),
                pa.array([[{"line": k, "size": n} for k, n in f[3]] for f in found], sized),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), *columns], names=schema.names)

    return spread(narrow).mapInArrow(run, schema)


def residue(df: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The `key` of records whose residual is, or still contains, placeholders, filler, an error page or a script notice.

    The residual is a record without the lines that its host repeats. A message is told by what the residual
    holds beside it, so a page of nothing but boilerplate and a message is one even if the host repeats the
    message too. Null and empty texts are no residue. Keys are taken to be unique; repeated ones come out
    once. A null host is one of its own. Of each line a key of 64 bits is shuffled, once for each distinct
    text and counted map-side first, so a host that holds a third of all records costs no more than others.
    """
    judged = cut(_judged(df, key, text, host))  # read several times below, and dear to make
    texts = judged.select("__host", "digest", "lines").dropDuplicates(["__host", "digest"])  # copies of a text are one
    hosts = judged.select("__host", "digest").distinct().groupBy("__host").agg(F.count(F.lit(1)).alias("texts"))
    asked = judged.where(F.col("message") | (F.size("anywhere") > 0)).select("__key", "__host", "message", "anywhere", "beside")
    # Only lines of records with some evidence need their counts.
    wanted = asked.select("__host", F.explode(F.array_distinct(F.concat("anywhere", F.transform("beside", lambda x: x["line"])))).alias("line")).distinct()
    counts = texts.select("__host", F.explode("lines").alias("line")).groupBy("__host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= RECURRENT_TEXTS)
    recurrent = wanted.join(counts, ["__host", "line"]).join(hosts, "__host").where(F.col("n") >= F.lit(RECURRENT_SHARE) * F.col("texts"))
    known = recurrent.select("__host", "line", F.lit(True).alias("known"))
    left_over = asked.select("__key", "__host", F.explode("anywhere").alias("line")).join(known, ["__host", "line"], "left_anti").select("__key")
    beside = asked.where("message").select("__key", "__host", F.explode_outer("beside").alias("b")).select("__key", "__host", "b.line", "b.size")
    size = F.when(F.col("known") | F.col("line").isNull(), 0).otherwise(F.col("size"))
    alone = beside.join(known, ["__host", "line"], "left").groupBy("__key").agg(F.sum(size).alias("left")).where(F.col("left") <= LEFT_CHARS).select("__key")
    return left_over.unionByName(alone).distinct().select(F.col("__key").alias(key))


def without_residue(df: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """df without the records that `residue` names; rows with a null key stay."""
    return df.join(residue(df, key, text, host), key, "left_anti")
