"""Registry, table access and the texts that queries derive from the tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.text import BLANK
from sluice.session import intermediates

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder, for file round trips."""
    return f"{intermediates(spark)}/files-{uuid.uuid4().hex}"


def rename_files(spark: SparkSession, pattern: str, old: str, new: str) -> None:
    """Give the files of ``pattern`` another ending: Spark's writers choose their own."""
    jvm, context = spark.sparkContext._jvm, spark.sparkContext
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(context._jsc.hadoopConfiguration())
    for found in system.globStatus(path) or []:
        name = found.getPath().toString()
        system.rename(found.getPath(), jvm.org.apache.hadoop.fs.Path(name.removesuffix(old) + new))


def r6(value: Column, name: str) -> Column:
    return F.round(value, 6).alias(name)


# ---- SQL fragments ----------------------------------------------------------

WS = BLANK


def s_strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A[{WS}]+|[{WS}]+\z', '', 'g')"


def s_words(x: str) -> str:
    return f"regexp_extract_all({x}, '[^{WS}]+')"


def s_count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


def s_ratio(a: str, b: str) -> str:
    return f"(case when {b} = 0 then 0.0::double else ({a})::double / ({b}) end)"


def s_list(items) -> str:
    return "[" + ", ".join(s_str(i) for i in items) + "]"


def s_str(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def s_pick(key: str, n: str) -> str:
    return f"(('0x' || substr(md5({key}), 1, 6))::int % ({n}))"


# ---- derived water-domain texts ---------------------------------------------
# The tables hold no Chinese text. Every word of a document is mapped to a word
# of this list by its length and outer characters, so the derived texts grow
# with the table and differ from row to row.

WORDS = [
    "水文", "的", "降雨量达到", "12.5mm", "径流", "长江", "是", "流域", "水库", "在",
    "防洪", "调度", "监测", "管理", "大坝", "因为", "所以", "技术", "方法", "数据",
    "水位", "上升了", "河道", "治理", "生态", "保护", "35%", "灌溉", "水质", "首先",
    "最后", "与", "较为重要", "工程", "建设", "设计", "1,250立方米", "H2O", "洪水", "三峡",
    "预警", "汛期", "黄河", "今年", "蒸发", "气象站", " water ", " river ", "（渗透）", "降水",
    "水坝", "年", "南水北调", "稳定运行", "《规划》", "地下水",
]


# Every form of a word of the list: bare or with a mark, without or with a line break.
FORMS = [word + mark + line for word in WORDS for mark in ("", "。", "，") for line in ("", "\n")]
# Rows whose words a Python worker holds at once.
TEXT_ROWS = 256


def _code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The code points of the UTF-8 characters that start at the places ``at``."""
    codes = data[at].astype(np.int64)
    wide = np.flatnonzero(codes > 127)
    lead, starts = codes[wide], at[wide]
    more = (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)
    found = lead & (0x3F >> more)
    for k in (1, 2, 3):
        following = data[np.minimum(starts + k, len(data) - 1)] & 0x3F
        found = np.where(more >= k, found << 6 | following, found)
    codes[wide] = found
    return codes


def _ends(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last code point of each word, zeros for an empty one."""
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.append(np.frombuffer(data or b"", dtype=np.uint8), np.uint8(0))
    first, last = at[:-1], np.maximum(at[1:] - 1, at[:-1])
    for _ in range(3):
        last = last - ((data[last] & 0xC0) == 0x80)
    return tuple(np.where(at[1:] > first, _code_points(data, ends), 0) for ends in (first, last))


def _derived(texts: pa.StringArray) -> pa.StringArray:
    lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
    words = lists.flatten()
    first, last = _ends(words)
    at = (pc.utf8_length(words).to_numpy() * 7 + first * 3 + last) % len(WORDS)
    stop, comma, line = (pc.match_substring(words, mark).to_numpy(zero_copy_only=False) for mark in (".", ",", "\n"))
    at = (at * 3 + np.where(stop, 1, np.where(comma, 2, 0))) * 2 + line
    forms = pa.array(FORMS).take(pa.array(at))
    return pc.if_else(texts.is_valid(), pc.binary_join(pa.ListArray.from_arrays(lists.offsets, forms), ""), None)


def derived_texts(batches: Iterator[pa.StringArray]) -> Iterator[pa.StringArray]:
    """Each word replaced by that of the list which its length and outer characters name."""
    for texts in batches:
        for at in range(0, len(texts), TEXT_ROWS):
            yield _derived(texts.slice(at, TEXT_ROWS))


def zh_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    @F.arrow_udf("string")
    def derived(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return derived_texts(batches)

    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.lit("zh").alias("language"), "source", derived("text").alias("content"))


ZH = rf"""zh as (
  select doc_id, 'zh' as language, source, array_to_string(list_transform(string_split(text, ' '), lambda w:
    ({s_list(WORDS)})[1 + (length(w) * 7 + ascii(left(w, 1)) * 3 + ascii(right(w, 1))) % {len(WORDS)}]
    || (case when contains(w, '.') then '。' when contains(w, ',') then '，' else '' end)
    || (case when contains(w, chr(10)) then chr(10) else '' end)), '') as content
  from documents)"""
