"""Relay, schedule and id-list documents derived from the order table.

Every order is one relay; an inning of a game holds eight orders, so a document
is put together from at most eight rows. Values come as numbers, as text, as
JSON null or not at all, by arithmetic on the customer key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from diamondlake.plans.pitch_view import GAME_ID, ORDERS_PER_GAME, table


def relay_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey as c",
        f"cast(floor(o_orderkey / {ORDERS_PER_GAME}) as bigint) as g",
        f"cast(o_orderkey % {ORDERS_PER_GAME} as bigint) as p",
    )
    return placed.selectExpr(
        "c", "g", "p",
        f"{GAME_ID} as game_id",
        "cast(1 + floor(p / 8) + case when g % 19 = 2 then 6 else 0 end as int) as inning",
        "cast(floor(p / 4) % 2 as int) as code",
    )


def _q(text: str) -> Column:
    return F.expr(text)


def _pitch(i: Column) -> Column:
    k = F.col("c") + i

    def pick(mod: int, *cases: str) -> Column:
        out = F.lit(cases[-1])
        for n, case in reversed(list(enumerate(cases[:-1]))):
            out = F.when(k % mod == n, F.lit(case)).otherwise(out)
        return out

    speed = F.when(k % 6 == 0, F.concat(F.lit(',"speed":'), (i + 140).cast("string"))).otherwise(
        pick(6, "", ',"speed":"145.5"', ',"speed":""', ',"speed":null', ',"speed":"n/a"', "")
    )
    state = F.concat(
        F.lit(',"currentGameState":{"batter":'), (F.col("p") + 5000).cast("string"),
        _q("case c % 8 when 0 then '' when 1 then ',\"pitcher\":null' when 2 then ',\"pitcher\":\"1001\"'"
           " else concat(',\"pitcher\":', cast(2000 + code as string)) end"),
        _q("case c % 10 when 0 then ',\"homeScore\":\"\"' when 1 then ''"
           " else concat(',\"homeScore\":\"', cast(c % 9 as string), '\"') end"),
        _q("concat(',\"awayScore\":', cast(c % 7 as string))"),
        _q("case c % 4 when 3 then '' when 2 then ',\"out\":null' else concat(',\"out\":', cast(c % 3 as string)) end"),
        F.concat(F.lit(',"ball":'), (i % 4).cast("string"), F.lit(',"strike":"2"')),
        _q("case c % 5 when 0 then ',\"base1\":\"0\"' when 1 then ',\"base1\":0' when 2 then ',\"base1\":3'"
           " when 3 then ',\"base1\":null' else ',\"base1\":\"x\"' end"),
        _q("case when c % 2 = 0 then ',\"base3\":\"12\"' else ',\"base3\":\"0.5\"' end"),
        F.lit("}"),
    )
    return F.concat(
        F.when(k % 19 == 0, '{"type":"1"').otherwise('{"type":1'),
        speed,
        pick(3, ',"stuff":"FAST"', ',"stuff":""', ""),
        pick(11, "", ',"pitchResult":null', ',"pitchResult":""', ',"pitchResult":"S"'),
        state,
        F.lit("}"),
    )


def _relay() -> Column:
    record = _q(
        "case when c % 37 = 0 then 'null' else concat('{',"
        " case c % 6 when 0 then '\"todayHra\":0,' when 1 then '\"todayHra\":\"0.000\",' when 2 then '\"todayHra\":\"\",'"
        "   when 3 then '\"todayHra\":null,' when 4 then '\"todayHra\":0.25,' else '' end,"
        " case c % 4 when 0 then '\"seasonHra\":\"0.3\",' when 1 then '\"seasonHra\":0.125,' when 2 then '\"seasonHra\":\"-\",' else '' end,"
        " case c % 5 when 0 then '\"hitType\":\"우투좌타\",' when 1 then '\"hitType\":\"우투우타\",'"
        "   when 2 then '\"hitType\":\"우투양타\",' when 3 then '\"hitType\":\"\",' else '' end,"
        " case c % 3 when 0 then '\"vsHra\":\"0.5\"' when 1 then '\"vsHra\":null' else '\"vsHra\":0.75' end, '}') end"
    )
    batter = F.when(F.col("c") % 41 != 0, F.array(F.concat(F.lit('{"type":8,"batterRecord":'), record, F.lit("}"))))
    count = F.col("c") % 7
    pitches = F.when(
        count > 0, F.transform(F.sequence(F.lit(1).cast("bigint"), count), _pitch)
    )
    result = F.when(
        F.col("c") % 43 != 0,
        F.array(_q(
            "concat('{\"type\":', case when c % 2 = 0 then '13' else '23' end, ',\"text\":',"
            " case c % 14 when 0 then '\"좌월 홈런\"' when 5 then '\"볼넷\"' when 7 then '\"헛스윙 삼진 아웃\"'"
            " when 12 then 'null' else '\"기타\"' end, '}')"
        )),
    )
    again = F.when(
        F.col("c") % 61 == 0,
        F.array(F.lit('{"type":8,"batterRecord":{"todayHra":0.9,"vsHra":0.9,"hitType":"우투양타"}}')),
    )
    none = F.array().cast("array<string>")
    listed = F.concat(*[F.coalesce(part, none) for part in (batter, pitches, result, again)])
    options = F.when(F.col("c") % 29 == 0, "").otherwise(F.array_join(listed, ","))
    return F.concat(
        F.lit("{"),
        _q("case when c % 47 = 0 and code = 0 then '' when c % 53 = 0 then concat('\"homeOrAway\":', cast(code as string), ',')"
           " else concat('\"homeOrAway\":\"', cast(code as string), '\",') end"),
        _q("case when c % 59 = 2 then '\"inn\":null,' when c % 5 = 0 then ''"
           " when c % 31 = 1 then concat('\"inn\":\"', cast(inning as string), '\",')"
           " else concat('\"inn\":', cast(inning as string), ',') end"),
        _q("case c % 3 when 0 then concat('\"metricOption\":{\"wpaByPlate\":', cast(c % 41 - 20 as string), '.5},')"
           " when 1 then '\"metricOption\":null,' else '' end"),
        F.lit('"textOptions":['), options, F.lit("]}"),
    )


def relay_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(game_id, req_inning, payload): one document per game and inning, some empty, some missing."""
    # Spread the narrow rows first: the JSON is built after the exchange and never moved.
    # The number is given, since the rows grow a hundredfold after the exchange and
    # the adaptive planner would fold partitions by their size before it.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = relay_orders(spark, sf_dir).repartition(parts, "g", "game_id", "inning")
    relays = spread.withColumn("entry", F.struct("code", (-F.col("p")).alias("back"), _relay().alias("json")))
    gathered = relays.groupBy("g", "game_id", "inning").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    listed = F.array_join(F.transform("entries", lambda e: e["json"]), ",")
    payload = (
        F.when(_q("g % 7 = 3 and inning = 6"), '{"result":{"textRelayData":{"textRelays":[]}}}')
        .when(_q("g % 11 = 5 and inning = 1"), '{"result":{"textRelayData":{"textRelays":null}}}')
        .when(_q("g % 8 = 1 and inning = 8"), '{"result":{}}')
        .when(_q("g % 23 = 9 and inning = 4"), '{"result":{"textRel')
        .when(_q("g % 23 = 10 and inning = 5"), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit('{"result":{"textRelayData":{"textRelays":['), listed, F.lit("]}}}")))
    )
    present = gathered.where("not (g % 13 = 4 and inning = 3)")
    return present.select("game_id", F.col("inning").alias("req_inning"), payload.alias("payload"))


def schedule_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(payload): nine games or fewer per document, the list under ``result`` or at the top."""
    games = relay_orders(spark, sf_dir).select("g", "game_id").distinct()
    entry = _q(
        "concat('{\"gameId\":\"', game_id, '\",\"homeTeamCode\":\"', substring(game_id, 11, 2),"
        " '\",\"awayTeamCode\":\"', substring(game_id, 9, 2), '\",\"statusCode\":\"',"
        " case when g % 7 = 0 then 'BEFORE' else 'RESULT' end, '\"',"
        " case when g % 11 = 0 then ',\"cancel\":true' when g % 2 = 0 then ',\"cancel\":false' else '' end, '}')"
    )
    gathered = games.groupBy(_q("floor(g / 9)").alias("batch")).agg(
        F.sort_array(F.collect_list(F.struct("g", entry.alias("json")))).alias("games")
    )
    listed = F.concat(F.lit('"games":['), F.array_join(F.transform("games", lambda e: e["json"]), ","), F.lit("]"))
    payload = (
        F.when(_q("batch % 4 = 0"), F.concat(F.lit("{"), listed, F.lit("}")))
        .when(_q("batch % 4 = 1"), F.concat(F.lit('{"result":{},'), listed, F.lit("}")))
        .otherwise(F.concat(F.lit('{"result":{'), listed, F.lit("}}")))
    )
    return gathered.select(payload.alias("payload"))


def id_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): padded ids and blank lines, one line per order."""
    return relay_orders(spark, sf_dir).selectExpr(
        "case when p % 3 = 0 then concat(' ', game_id, '\\t ') when p % 3 = 1 then '  \\t' else '' end as value"
    )
