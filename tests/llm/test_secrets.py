"""The secret scan: held-out recall and false alarms, its array helpers against plain versions, time on many matches."""

import hashlib
import random
import string
import time

import pytest
from pyspark.sql import functions as F

from obligato.llm import secrets

ORDINARY = """
    getElementsByClassName XMLHttpRequestFactoryBean qwertyuiop Krzyzewski Donaudampfschifffahrtsgesellschaft ABCDEFGHIJKLMNOP AAAAAAAAAAAAAAAA
    AbstractSingletonProxyFactoryBean addEventListener MAX_CONNECTION_POOL_SIZE user_profile_picture_url kubernetes-dashboard-service
    i18n_messages_properties libstdc++ x86_64-linux-gnu python3-setuptools DEFAULT_CHARSET_UTF8 processPaymentTransaction onMouseOverHandler
    ThreadPoolExecutor ConcurrentHashMap application/json text/html/charset Wolkenkratzer Geschwindigkeitsbegrenzung Versicherungsgesellschaft
    internationalization incomprehensibilities antidisestablishmentarianism Schwarzenegger Tchaikovsky Rzeszow Szczecin Przemysl quickbrownfoxjumps
    getUserById2 HTTPServletResponse SQLException JSONObject parseXMLDocument setTimeoutMillis innerHTMLElement webkitRequestAnimationFrame
    node_modules/react-dom src/main/java/com/example README_INSTALL CHANGELOG v2_0_1-beta3 release-2024-01-15 build_20231105 customer_order_line_items
    tbl_employee_salary idx_customer_name fk_order_customer BROWSER_WINDOW_HEIGHT camelCaseString PascalCaseString com/google/common/collect
    org/apache/spark/sql/catalyst background-color border-left-width margin-bottom text-decoration-underline password_reset_expiry
    session_cookie_httponly GITHUB_ACTIONS DATABASE_URL REDIS_HOST_PORT mailto_subject encyclopaedia otorhinolaryngologist Hauptbahnhof
    Fussballweltmeisterschaft Bundesverfassungsgericht desarrollador constitucionalidad extraordinairement developpement gouvernement
    abcabcabcabc xxxxxxxxxxxx JavaScriptEngine TypeScriptCompiler PostgreSQLConnection GraphQLSchemaBuilder OAuth2AuthenticationProvider
    utf8mb4_unicode_ci ISO8859-1 IPv4AddressRange sha256sum base64encode wp-content/uploads/2021/05 index_page_2 Lorem_ipsum_dolor_sit_amet
    consectetur adipiscing_elit tempor-incididunt Wirtschaftsministerium""".split()


@pytest.fixture(scope="module")
def ratios(spark):
    return secrets.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def marked(spark, ratios, strings):
    rows = spark.createDataFrame([(i, f"see {s} there") for i, s in enumerate(strings)], "doc_id long, text string")
    return {r.doc_id for r in secrets.scan(rows, ratios).collect() if "random" in r.spans}


def test_recall_and_false_alarms(spark, ratios):
    dice = random.Random(11)
    letters = string.ascii_letters + string.digits
    strings = ["".join(dice.choice(a) for _ in range(n)) for a in (letters, letters + "+/") for n in (16, 20, 24, 32) for _ in range(50)]
    found = marked(spark, ratios, strings)
    assert len(found) >= 0.9 * len(strings)
    alarms = [ORDINARY[i] for i in marked(spark, ratios, ORDINARY)]
    assert len(alarms) <= 0.01 * len(ORDINARY), alarms


def test_words_of_the_documents_are_ordinary(spark, ratios):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = secrets.scan(docs, ratios).select(F.sum(F.size(F.filter(F.split("spans", ","), lambda s: s.startswith("random")))).alias("n"),
                                              F.sum("n_assign").alias("assign")).first()
    assert found.n == 0 and found.assign > 5


def test_work_follows_the_length(spark, ratios):
    def seconds(n):
        text = " ".join(hashlib.md5(str(i).encode()).hexdigest()[:18] for i in range(n))
        rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.perf_counter()
        assert secrets.scan(rows, ratios).first().n_hex == n
        assert secrets.redact(rows, ratios).first().text == " ".join(["[SECRET]"] * n)
        return time.perf_counter() - start

    seconds(10)
    few, many = seconds(10_000), seconds(40_000)
    assert many < 4 * few + 10 and few < 60


def cut(text, spans):
    out, at = [], 0
    for start, end in spans:
        out += [text[at:start] if start > at else "", f"<{max(start, at)}-{max(end, at)}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_cuts_and_running_totals_are_those_of_plain_versions(spark):
    dice, rows = random.Random(4), []
    for n in [0, 1, 2, 3, 4, 5, 8, 9, 10, 50, 101]:
        text = "".join(dice.choice(["a", "é", "日", "\U0001f389", "﻿", "\n", "￾"]) for _ in range(120))
        spans = sorted((s, min(120, s + dice.randrange(1, 9))) for s in (dice.randrange(119) for _ in range(n)))
        rows.append((text, [tuple(s) for s in spans], [dice.randrange(100) for _ in range(n)]))
    frame = spark.createDataFrame(rows, "t string, s array<struct<start:int,end:int>>, v array<int>")
    instead = lambda s, before: F.concat(F.lit("<"), F.greatest(s["start"], before), F.lit("-"), F.greatest(s["end"], before), F.lit(">"))
    got = frame.select(secrets._cut(F.col("t"), F.col("s"), instead).alias("cut"),
                       secrets._running(F.col("v"), lambda a, b: a + b).alias("sums"),
                       secrets._running(F.col("v"), lambda a, b: F.greatest(a, b)).alias("tops")).collect()
    for (text, spans, values), r in zip(rows, got):
        assert r.cut == cut(text, spans)
        assert r.sums == [sum(values[:i + 1]) for i in range(len(values))]
        assert r.tops == [max(values[:i + 1]) for i in range(len(values))]


def test_a_repeated_id_does_not_fill_the_sample(spark):
    rows = spark.range(3000).selectExpr("7 AS doc_id", "CONCAT('word', id, ' other words here') AS text").union(
        spark.createDataFrame([(8, "plain"), (None, "no id"), (9, None)], "doc_id long, text string"))
    assert secrets._labelled_strings(rows).where("source = 'words'").count() <= 4
    assert len(secrets.train(rows.limit(0))) == 128 ** 2
