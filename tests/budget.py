"""A small made-up budget: two years, a general and two special funds, a line for every kind of rule."""

from __future__ import annotations

from tallywright.model import EXPENDITURE, LAYOUTS, PARTITIONS, REVENUE, RULES_DDL, Layout

CITY, LAYOUT = "132047", LAYOUTS["132047"]
GENERAL, HEALTH, CARE = "01一般会計", "02国民健康保険事業特別会計", "03介護保険事業特別会計"

RULES = [
    (1, "transfer-health", CITY, None, None, None, "国民健康保険事業特別会計繰出金", "contains", "繰出金", "assigned", "07", "eliminated", "目", "国民健康保険事業特別会計", "paid to health"),
    (2, "transfer-care", CITY, None, None, None, "介護保険事業特別会計繰出金", "contains", "繰出金", "assigned", "10", "eliminated", "目", "介護保険事業特別会計", "paid to care"),
    (3, "debt-principal", None, None, "公債費", None, "元金", "eq", None, "out-of-scope", None, "retained", "目", None, "repayment"),
    (4, "saving", None, None, None, None, None, None, "積立金", "out-of-scope", None, "retained", "節", None, "saved"),
    (5, "planning", CITY, None, None, "都市計画費", "都市計画総務費|再開発事業費", "eq", None, "assigned", "06", "retained", "目", None, "planning"),
    (6, "schools", CITY, None, None, "教育総務費|小学校費|中学校費", None, None, None, "assigned", "09", "retained", "項", None, "schools"),
    (7, "council", None, None, "議会費", None, None, None, None, "assigned", "01", "retained", "款", None, "council"),
    (8, "fund-health", CITY, "国民健康保険事業特別会計", None, None, None, None, None, "assigned", "07", "retained", "会計", None, "health"),
    (9, "elsewhere", "999999", None, None, None, None, None, None, "assigned", "02", "retained", "会計", None, "another body"),
]

SPENT = [
    (GENERAL, "01議会費", "01議会費", "01議会費", "01運営", "01報酬", "01議員", 300),
    (GENERAL, "03民生費", "01社会福祉費", "05国民健康保険事業特別会計繰出金", "01繰出", "28繰出金", "01繰出金", 120),
    (GENERAL, "03民生費", "02老人福祉費", "03介護保険事業特別会計繰出金", "01繰出", "28繰出金", "01繰出金", 80),
    (GENERAL, "08土木費", "04都市計画費", "01都市計画総務費", "01計画", "12委託料", "01Ⅰ型事業委託料", 50),
    (GENERAL, "08土木費", "04都市計画費", "02再開発事業費", "01再開発", "12委託料", "01調査", 70),
    (GENERAL, "10教育費", "02小学校費", "01学校管理費", "01管理", "10需用費", "01郵便料", 90),
    (GENERAL, "12公債費", "01公債費", "01元金", "01償還", "22償還金", "01元金", 60),
    (GENERAL, "02総務費", "01総務管理費", "09財政調整基金費", "01積立", "24積立金", "01積立金", 40),
    (GENERAL, "13諸支出金", "01雑支出", "01雑支出", "01雑", "01雑", "01雑", 10),
    (HEALTH, "02保険給付費", "01療養諸費", "01療養給付費", "01給付", "18負担金", "01給付費", 120),
    (CARE, "02保険給付費", "01介護諸費", "01介護給付費", "01給付", "18負担金", "01給付費", 80),
]
GOT = [
    (GENERAL, "01市税", "01市民税", "01個人", "01現年", "01現年", "0", 820),
    (HEALTH, "05繰入金", "01一般会計繰入金", "01一般会計繰入金", "01繰入", "01繰入", "0", 120),
    (CARE, "05繰入金", "01一般会計繰入金", "01一般会計繰入金", "01繰入", "01繰入", "0", 80),
]


def raw(spark, direction: str, rows=None, years=(2024, 2025), layout: Layout = LAYOUT, change=None):
    rows = (SPENT if direction == EXPENDITURE else GOT) if rows is None else rows
    out = []
    for year in years:
        for i, r in enumerate(rows, 2):
            line = [i, *r[:-1], str(r[-1]), CITY, str(year), "approved", direction]
            out.append(line)
    if change:
        out = change(out)
    names = ", ".join(f"`{c}` string" for c in layout.columns[direction])
    return spark.createDataFrame([tuple(r) for r in out], f"source_row bigint, {names}, " + ", ".join(f"{p} string" for p in PARTITIONS))


def rules(spark):
    return spark.createDataFrame(RULES, RULES_DDL)


__all__ = ["CITY", "EXPENDITURE", "LAYOUT", "REVENUE", "raw", "rules"]
