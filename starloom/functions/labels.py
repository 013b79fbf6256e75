"""Label vocabularies. The values are data that results must carry verbatim."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefecture -> region.
REGIONS: dict[str, tuple[str, ...]] = {
    "北海道": ("北海道",),
    "東北": ("青森県", "岩手県", "宮城県", "秋田県", "山形県", "福島県"),
    "関東": ("茨城県", "栃木県", "群馬県", "埼玉県", "千葉県", "東京都", "神奈川県"),
    "中部": ("新潟県", "富山県", "石川県", "福井県", "山梨県", "長野県", "岐阜県", "静岡県", "愛知県"),
    "関西": ("三重県", "滋賀県", "京都府", "大阪府", "兵庫県", "奈良県", "和歌山県"),
    "中国": ("鳥取県", "島根県", "岡山県", "広島県", "山口県"),
    "四国": ("徳島県", "香川県", "愛媛県", "高知県"),
    "九州・沖縄": ("福岡県", "佐賀県", "長崎県", "熊本県", "大分県", "宮崎県", "鹿児島県", "沖縄県"),
}
UNKNOWN = "不明"

# Upper age bound (exclusive) -> band; the last band is open.
AGE_BANDS: tuple[tuple[int, str], ...] = ((30, "20代"), (40, "30代"), (50, "40代"), (60, "50代"))
OLDEST_BAND = "60代以上"

# First hour of each part of the day.
DAY_PARTS: tuple[tuple[int, str], ...] = (
    (0, "深夜"), (5, "早朝"), (7, "朝"), (10, "昼前"), (12, "昼"), (15, "午後"), (18, "夕方"), (21, "夜"),
)
BUSINESS_HOURS = (9, 17)

# Order status -> label.
STATUS_LABELS: dict[str, str] = {
    "pending": "保留中",
    "confirmed": "確認済",
    "shipped": "発送済",
    "delivered": "配達完了",
    "cancelled": "キャンセル",
}
CANCELLED = "cancelled"

# Customer segments, and the label of a customer who never bought.
CHAMPION, LOYAL, PROMISING, AT_RISK, DORMANT, OTHER = (
    "チャンピオン", "ロイヤル", "有望", "リスクあり", "休眠", "その他",
)
NEVER_BOUGHT = "未購入"
SEGMENTS = (CHAMPION, LOYAL, PROMISING, AT_RISK, DORMANT, OTHER, NEVER_BOUGHT)

# Product ranks with the cumulative share, in percent, each one ends at.
ABC_CUTS: tuple[tuple[int, str], ...] = ((60, "A"), (85, "B"))
LOWEST_RANK = "C"
ABC_RANKS = ("A", "B", "C")

# Page types a purchase session walks through.
FUNNEL_STAGES = ("top", "category", "product", "cart", "checkout", "complete")
DASHBOARD_STAGES = ("home", "category", "product", "cart", "complete")


def lookup(key: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Map a small vocabulary with one literal map, so no join is planned."""
    known = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(known, key), F.lit(default))


def first_match(cases: Sequence[tuple[Column, Column]], default: Column) -> Column:
    """The value of the first condition that holds."""
    return reduce(lambda rest, case: F.when(case[0], case[1]).otherwise(rest), reversed(cases), default)


def region_of(prefecture: Column, regions: Mapping[str, Sequence[str]] = REGIONS) -> Column:
    by_prefecture = {name: region for region, names in regions.items() for name in names}
    return lookup(prefecture, by_prefecture, UNKNOWN)


def age_band(birth_date: Column, as_of: Column) -> Column:
    years = F.year(as_of) - F.year(birth_date)
    bands = [(years < limit, F.lit(band)) for limit, band in AGE_BANDS]
    return first_match([(birth_date.isNull(), F.lit(UNKNOWN)), *bands], F.lit(OLDEST_BAND))


def day_part(hour: Column) -> Column:
    parts = [(hour >= start, F.lit(name)) for start, name in reversed(DAY_PARTS)]
    return first_match(parts, F.lit(None))


def status_label(status: Column) -> Column:
    return lookup(status, STATUS_LABELS, UNKNOWN)


def abc_rank(cumulative: Column, total: Column) -> Column:
    """Compared in exact decimals, so that a share on the cut falls on the right side of it."""
    return first_match([(cumulative * 100 <= total * cut, F.lit(rank)) for cut, rank in ABC_CUTS], F.lit(LOWEST_RANK))
