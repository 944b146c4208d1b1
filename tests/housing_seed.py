"""The course's six seed tables, as literal rows.

--- fixed values: the course's seed data, reproduced as given, in its order ---
They must equal the course's rows for the goldens in FIXTURES.md to hold.
"""

REGION_ROWS = [
    ("11", "서울", "COA0083", "수도권"),
    ("41", "경기", "COA0083", "수도권"),
    ("28", "인천", "COA0083", "수도권"),
    ("26", "부산", "COA0083", "지방"),
    ("27", "대구", "COA0083", "지방"),
    ("29", "광주", "COA0083", "지방"),
    ("30", "대전", "COA0083", "지방"),
    ("51", "강원", "COA0083", "지방"),
]

STATUS_ROWS = [
    ("20200630", "G-2020-0001", "11", "07", 12400, 120, 30, 10, 4.2),
    ("20200630", "G-2020-0002", "11", "08", 8200, 80, 20, 5, 3.1),
    ("20200630", "G-2020-0003", "11", "09", 5100, 50, 10, 3, 2.4),
    ("20200630", "G-2020-0004", "41", "07", 18700, 180, 40, 12, 3.8),
    ("20200630", "G-2020-0005", "41", "08", 11500, 110, 25, 8, 4.2),
    ("20200630", "G-2020-0006", "28", "07", 5800, 55, 12, 4, 2.1),
    ("20200630", "G-2020-0007", "26", "07", 4200, 40, 10, 3, 1.9),
    ("20200630", "G-2020-0008", "26", "08", 2900, 28, 7, 2, 1.7),
    ("20210630", "G-2021-0001", "11", "07", 13200, 130, 32, 11, 4.5),
    ("20210630", "G-2021-0002", "11", "08", 9100, 90, 22, 6, 3.4),
    ("20210630", "G-2021-0003", "11", "07", 22000, 220, 50, 15, 4.8),
    ("20210630", "G-2021-0004", "41", "07", 20100, 200, 45, 13, 4.1),
    ("20210630", "G-2021-0005", "41", "08", 13200, 130, 30, 9, 5.1),
    ("20210630", "G-2021-0006", "28", "07", 6400, 62, 14, 5, 2.6),
    ("20210630", "G-2021-0007", "27", "07", 3100, 30, 8, 2, 2.0),
    ("20210630", "G-2021-0008", "29", "08", 1800, 17, 4, 1, 1.8),
    ("20220630", "G-2022-0001", "11", "07", 11800, 115, 28, 9, 4.8),
    ("20220630", "G-2022-0002", "11", "08", 8600, 84, 21, 6, 3.3),
    ("20220630", "G-2022-0003", "11", "07", 25000, 250, 55, 18, 5.2),
    ("20220630", "G-2022-0004", "41", "07", 19200, 190, 43, 12, 4.3),
    ("20220630", "G-2022-0005", "41", "09", 8400, 82, 18, 6, 3.1),
    ("20220630", "G-2022-0006", "26", "07", 4500, 44, 11, 3, 1.9),
    ("20220630", "G-2022-0007", "30", "07", 2100, 20, 5, 2, 1.6),
    ("20220630", "G-2022-0008", "51", "08", 980, 9, 2, 1, 1.5),
    ("20230630", "G-2023-0001", "11", "07", 10500, 102, 25, 8, 5.1),
    ("20230630", "G-2023-0002", "11", "08", 7800, 76, 19, 5, 3.9),
    ("20230630", "G-2023-0003", "11", "07", 27500, 275, 60, 20, 5.8),
    ("20230630", "G-2023-0004", "41", "07", 17900, 175, 40, 11, 4.5),
    ("20230630", "G-2023-0005", "41", "08", 12100, 118, 28, 8, 4.8),
    ("20230630", "G-2023-0006", "28", "07", 5200, 50, 12, 4, 3.0),
    ("20230630", "G-2023-0007", "27", "08", 2400, 23, 6, 2, 2.1),
    ("20230630", "G-2023-0008", "29", "07", 1900, 18, 5, 1, 1.9),
]

AMOUNT_ROWS = [
    ("20200630", "G-2020-0001", 1850.5, "20241201"),
    ("20200630", "G-2020-0002", 3120.0, None),
    ("20200630", "G-2020-0003", 2340.0, "20231015"),
    ("20200630", "G-2020-0004", 2100.0, None),
    ("20200630", "G-2020-0005", 4200.0, None),
    ("20200630", "G-2020-0006", 980.0, "20250101"),
    ("20200630", "G-2020-0007", 540.0, None),
    ("20200630", "G-2020-0008", 870.0, None),
    ("20210630", "G-2021-0001", 2050.0, None),
    ("20210630", "G-2021-0002", 3560.0, None),
    ("20210630", "G-2021-0003", 4100.0, None),
    ("20210630", "G-2021-0004", 2450.0, "20250301"),
    ("20210630", "G-2021-0005", 5100.0, None),
    ("20210630", "G-2021-0006", 1100.0, None),
    ("20210630", "G-2021-0007", 420.0, "20240601"),
    ("20210630", "G-2021-0008", 510.0, None),
    ("20220630", "G-2022-0001", 1920.0, None),
    ("20220630", "G-2022-0002", 3300.0, None),
    ("20220630", "G-2022-0003", 4800.0, None),
    ("20220630", "G-2022-0004", 2280.0, None),
    ("20220630", "G-2022-0005", 3100.0, None),
    ("20220630", "G-2022-0006", 580.0, None),
    ("20220630", "G-2022-0007", 310.0, None),
    ("20220630", "G-2022-0008", 220.0, None),
    ("20230630", "G-2023-0001", 1750.0, None),
    ("20230630", "G-2023-0002", 3050.0, None),
    ("20230630", "G-2023-0003", 5200.0, None),
    ("20230630", "G-2023-0004", 2100.0, None),
    ("20230630", "G-2023-0005", 4800.0, None),
    ("20230630", "G-2023-0006", 920.0, None),
    ("20230630", "G-2023-0007", 680.0, None),
    ("20230630", "G-2023-0008", 280.0, None),
]

PAYMENT_ROWS = [
    ("G-2020-0001", 124.5), ("G-2020-0002", 198.0), ("G-2020-0003", None),
    ("G-2020-0004", 142.0), ("G-2020-0005", 210.0), ("G-2020-0006", 85.0),
    ("G-2021-0001", 138.0), ("G-2021-0002", 215.0), ("G-2021-0003", None),
    ("G-2021-0004", 158.0), ("G-2021-0005", None), ("G-2021-0006", 92.0),
    ("G-2022-0001", 145.0), ("G-2022-0002", 220.0), ("G-2022-0003", 312.0),
    ("G-2022-0004", 162.0), ("G-2022-0005", None), ("G-2022-0006", None),
    ("G-2023-0001", 155.0), ("G-2023-0002", 235.0), ("G-2023-0003", 320.0),
    ("G-2023-0004", 170.0), ("G-2023-0005", None), ("G-2023-0006", 98.0),
]

AGE_ROWS = [
    ("G-2020-0001", 68), ("G-2020-0002", 72), ("G-2020-0003", 65),
    ("G-2020-0004", 70), ("G-2020-0005", 75), ("G-2020-0006", 63),
    ("G-2021-0001", 69), ("G-2021-0002", 73), ("G-2021-0003", 66),
    ("G-2021-0004", 71), ("G-2021-0005", 76), ("G-2021-0006", 64),
    ("G-2022-0001", 70), ("G-2022-0002", 74), ("G-2022-0003", 67),
    ("G-2022-0004", 72), ("G-2022-0005", 77), ("G-2022-0006", 65),
    ("G-2023-0001", 71), ("G-2023-0002", 75), ("G-2023-0003", 68),
    ("G-2023-0004", 73), ("G-2023-0005", 78), ("G-2023-0006", 66),
]

PRICE_ROWS = [
    ("202512", "G-2023-0001", 5.1, 5.0, "1"),
    ("202512", "G-2023-0002", 3.9, 3.8, "0"),
    ("202512", "G-2023-0003", 5.8, 5.7, "1"),
    ("202512", "G-2023-0004", 4.5, 4.4, "1"),
    ("202512", "G-2023-0005", 4.8, 4.7, "0"),
    ("202512", "G-2022-0001", 4.8, 4.7, "1"),
    ("202512", "G-2022-0002", 3.3, 3.2, "0"),
    ("202512", "G-2022-0003", 5.2, 5.1, "1"),
    ("202512", "G-2022-0004", 4.3, 4.2, "1"),
]

# Labels the course's CASE expressions produce.
PRODUCT_LABELS = {"07": "전세", "08": "구입", "09": "중도금"}
PRODUCT_OTHER = "기타"
CAPITAL, PROVINCE = "수도권", "지방"
REGION_GROUP = "COA0083"
SOURCE_BOARD, SOURCE_KB = "부동산원인터넷시세", "국민은행인터넷시세"
UNCANCELLED = "미해지"
