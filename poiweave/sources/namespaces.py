"""Words of a wiki's language: media and category links, redirects.

A dump's header names its own namespaces; ``read_namespaces`` takes them from the first bytes of one file for each wiki and
language. Older names that articles still use, and the words of redirects, are in no header: they are the fixed values below.
English words hold in every language.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poiweave.sources.catalog import first_files

HEADER_BYTES = 1 << 16
# Numbers of the media and the category namespace.
_MEDIA_OR_CATEGORY = re.compile(r'<namespace\b[^>]*\bkey="(?:6|14)"[^>]*>([^<]*)</namespace>')
WORDS_SCHEMA = "wiki string, lang string, own_words array<string>"

# Words of media and category links by language; the English ones hold everywhere.
ENGLISH = "file image category"
LINK_WORDS = [
    ("ar", "ملف صورة تصنيف"),
    ("bg", "файл картинка категория"),
    ("ca", "fitxer imatge categoria"),
    ("cs", "soubor obrázek kategorie"),
    ("da", "fil billede kategori"),
    ("de", "datei bild kategorie"),
    ("el", "αρχείο εικόνα κατηγορία"),
    ("eo", "dosiero kategorio"),
    ("es", "archivo imagen categoría"),
    ("et", "pilt fail kategooria"),
    ("eu", "fitxategi irudi kategoria"),
    ("fa", "پرونده تصویر رده"),
    ("fi", "tiedosto kuva luokka"),
    ("fr", "fichier catégorie"),
    ("gl", "ficheiro imaxe categoría"),
    ("he", "קובץ תמונה קטגוריה"),
    ("hr", "datoteka slika kategorija"),
    ("hu", "fájl kép kategória"),
    ("hy", "պատկեր կատեգորիա"),
    ("id", "berkas gambar kategori"),
    ("it", "immagine categoria"),
    ("ja", "ファイル 画像 カテゴリ"),
    ("kk", "сурет санат"),
    ("ko", "파일 그림 분류"),
    ("la", "fasciculus imago categoria"),
    ("lt", "vaizdas kategorija"),
    ("ms", "fail imej kategori"),
    ("nl", "bestand afbeelding categorie"),
    ("nn", "fil bilde kategori"),
    ("no", "fil bilde kategori"),
    ("pl", "plik grafika kategoria"),
    ("pt", "ficheiro imagem categoria"),
    ("ro", "fișier imagine categorie"),
    ("ru", "файл изображение категория"),
    ("sh", "datoteka slika kategorija"),
    ("sk", "súbor obrázok kategória"),
    ("sl", "slika datoteka kategorija"),
    ("sr", "датотека слика категорија"),
    ("sv", "fil bild kategori"),
    ("te", "దస్త్రం బొమ్మ వర్గం"),
    ("tr", "dosya resim kategori"),
    ("uk", "файл зображення категорія"),
    ("uz", "fayl tasvir turkum"),
    ("vi", "tập_tin hình thể_loại"),
    ("vo", "ragiv magod klad"),
    ("zh", "文件 图像 分类"),
]
# Words that begin a redirect by language; the English one holds everywhere.
ENGLISH_REDIRECT = "#redirect"
REDIRECT_WORDS = [
    ("ar", "#تحويل"),
    ("bg", "#виж #пренасочване"),
    ("cs", "#přesměruj"),
    ("da", "#omdirigering"),
    ("de", "#weiterleitung"),
    ("el", "#ανακατευθυνση"),
    ("eo", "#alidirektu"),
    ("es", "#redirección #redireccion"),
    ("et", "#suuna"),
    ("eu", "#birzuzendu"),
    ("fa", "#تغییر_مسیر #تغییرمسیر"),
    ("fi", "#ohjaus #uudelleenohjaus"),
    ("fr", "#redirection"),
    ("gl", "#redirección"),
    ("he", "#הפניה"),
    ("hr", "#preusmjeri"),
    ("hu", "#átirányítás"),
    ("hy", "#վերահղում"),
    ("id", "#alih"),
    ("it", "#rinvia #rinvio"),
    ("ja", "#転送 #リダイレクト"),
    ("kk", "#айдау"),
    ("ko", "#넘겨주기"),
    ("lt", "#peradresavimas"),
    ("ms", "#lencong"),
    ("nl", "#doorverwijzing"),
    ("nn", "#omdiriger"),
    ("no", "#omdirigering"),
    ("pl", "#patrz #przekieruj #tam"),
    ("pt", "#redirecionamento"),
    ("ro", "#redirecteaza"),
    ("ru", "#перенаправление #перенапр"),
    ("sh", "#preusmjeri"),
    ("sk", "#presmeruj"),
    ("sl", "#preusmeritev"),
    ("sr", "#преусмери"),
    ("sv", "#omdirigering"),
    ("te", "#దారిమార్పు"),
    ("tr", "#yönlendirme #yönlendir"),
    ("uk", "#перенаправлення"),
    ("vi", "#đổi"),
    ("vo", "#lüodükön"),
    ("zh", "#重定向"),
]


def _array(words: str) -> str:
    return f"array({', '.join(repr(w.replace('_', ' ')) for w in words.split())})"


def _by_language(table: list[tuple[str, str]], everywhere: str) -> str:
    """The words of the row's ``lang``; constants, so no join is needed."""
    branches = " ".join(f"when '{lang}' then {_array(f'{everywhere} {words}')}" for lang, words in table)
    return f"case lang {branches} else {_array(everywhere)} end"


def link_words() -> Column:
    return F.expr(_by_language(LINK_WORDS, ENGLISH))


def is_redirect(body: str = "body", by_language: bool = True) -> Column:
    """The body begins with a redirect word, of the row's ``lang`` too unless there is none; the longest has fewer than 40 characters."""
    words = _by_language(REDIRECT_WORDS, ENGLISH_REDIRECT) if by_language else _array(ENGLISH_REDIRECT)
    blanks = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
    start = f"replace(lower(substring(ltrim({blanks}, {body}), 1, 40)), '_', ' ')"
    return F.expr(f"exists({words}, w -> startswith({start}, w))")


def _beginning(spark: SparkSession, path: str) -> bytes:
    """The first bytes of a file, decompressed as its name says."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    place = hadoop.fs.Path(path)
    codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    stream = place.getFileSystem(conf).open(place)
    try:
        return bytes((stream if codec is None else codec.createInputStream(stream)).readNBytes(HEADER_BYTES))
    finally:
        stream.close()


def read_namespaces(spark: SparkSession, dumps: str | list[str]) -> DataFrame:
    """``wiki, lang, own_words``: the names that the dumps' headers give media and categories, in lower case.

    One file of each wiki and language is opened and its first bytes are read, without a job; a dump without a header gives no row.
    """
    rows = []
    for (wiki, lang), path in first_files(spark.read.text(dumps)).items():
        header = _beginning(spark, path).decode("utf-8", "replace").partition("</siteinfo>")[0]
        words = {html.unescape(w).replace("_", " ").strip().lower() for w in _MEDIA_OR_CATEGORY.findall(header)}
        if words - {""}:
            rows.append((wiki, lang, sorted(words - {""})))
    return spark.createDataFrame(rows, WORDS_SCHEMA)


def with_link_words(df: DataFrame, namespaces: DataFrame | None = None, name: str = "link_words") -> DataFrame:
    """Adds the words of media and category links, those of the dumps' headers among them.

    ``namespaces`` has a row for each wiki and language of the run at most, so it goes to every task.
    """
    known = link_words()
    if namespaces is None:
        return df.withColumn(name, known)
    own = F.coalesce("own_words", F.array().cast("array<string>"))
    return df.join(F.broadcast(namespaces), ["wiki", "lang"], "left").withColumn(name, F.array_union(known, own)).drop("own_words")
