"""Two landing days around a change of currency rates, with one fault of each kind.

The first day holds faults and dirty spellings; on the second a hotel grows,
another is new, one is no longer listed, a guest moves up a tier, a booking is
cancelled, a payment is refunded and a session goes on.
"""

import os

DAY1, DAY2 = "2026-06-30", "2026-07-01"

BOOKINGS_CSV = """\
booking_id,hotel_id,user_id,room_type,checkin_date,checkout_date,total_amount,currency,booking_status,source_channel,payment_method,created_at
R9,H10,C3,Twin,2026-06-20,2026-06-22,980000 d,VND,1,web,CASH,2026-06-15 18:20:00
R3,H20,C2,Dorm,2026-07-10,2026-07-11,Rp 775000,IDR,CONFIRM,APP_IOS,WALLET,2026-06-28 12:30:00
R3,H20,C2,Dorm,2026-07-10,2026-07-11,Rp 700000,IDR,PENDING,APP_IOS,WALLET,2026-06-28 10:00:00
R1,H30,C1,Loft,2026-07-04,2026-07-06,SGD 270.00,SGD, Confirmed ,Website,CARD,2026-06-29 21:05:00
R2,H10,C3,Twin,2026-07-02,2026-07-05,7'350'000,VND,canceled,partner_north,CARD,2026-06-30 07:45:10
R4, ,C1,Loft,2026-07-09,2026-07-10,135,SGD,CONFIRMED,web,CARD,2026-06-30 08:00:00
R10,H30,C1,Loft,2026-08-01,2026-08-03,on request,SGD,PENDING,web,,2026-06-30 08:10:00
"""

_BOOKINGS_XML = (
    ("R5", "H20", "", "Dorm", "2026-07-10", "2026-07-13", "1,000,000", "IDR", "no_show", "app_android", "CASH", "2026-06-30 05:00:00"),
    ("R6", "H20", "C2", "Dorm", "2026-07-15", "2026-07-16", "50.00", "", "CONFIRMED", "web", "CASH", "2026-06-30 05:30:00"),
    ("R7", "H30", "C5", "Loft", "2026-07-05", "2026-07-08", "432", "SGD", "CONFIRMED", "mobile app", "CARD", "2026-06-30 09:00:00"),
    ("R8", "H10", "C3", "Twin", "2026-07-18", "2026-07-18", "245000", "VND", "CONFIRMED", "web", "CASH", "2026-06-30 09:30:00"),
)

HOTELS = (
    ("H10", "Lotus Court", "midscale", "3", "Hue", "VN", "Central", "16.46", "107.59", "40", "['garden', 'Bar']", "2019-05-20", "y"),
    ("H20", "Merapi View", "economy", "2", "Yogyakarta", "ID", "Java", "-7.80", "110.37", "25", "[]", "2020-11-02", "0"),
    ("H30", "Harbour Nine", "upscale", "4", "Singapore", "SG", "Central", "1.29", "103.85", "120", "['lift', 'pool']", "2018-02-28", "TRUE"),
    ("H40", "", "midscale", "3", "Bandung", "ID", "Java", "-6.91", "107.61", "30", "[]", "2021-07-07", "true"),
    ("H50", "Starless", "economy", "0", "Pattaya", "TH", "Central", "12.93", "100.88", "12", "[]", "2022-09-09", "no"),
    ("H60", "Facade", "economy", "1", "Nha Trang", "VN", "Central", "12.24", "109.20", "0", "[]", "2023-10-10", "N"),
)
NEW_HOTEL = ("H70", "New Pier", "midscale", "4", "Phuket", "TH", "South", "7.89", "98.40", "60", "['boat']", "2026-07-01", "yes")

CUSTOMERS_CSV = """\
user_id,full_name,email,phone,country,user_segment,loyalty_tier,loyalty_points,first_booking_date,total_bookings,is_active,registered_at
C1,Mira Olsen,mira@mail.test,0901 000 111,SG,leisure,Blue,40,2025-02-02,2,true,2025-01-15
C2,Jon Ade,JON@mail.test,,ID,business,Red,910,2024-12-24,9,y,2024-10-01
C3,,c3@mail.test,+62 21 555 0100,VN,leisure,Blue,0,2026-06-15,1,no,2026-06-01
C4,Pia Roth,,+49 30 1234,ID,business,Red,77,2025-05-05,1,1,2025-05-01
C5,Lee Bo,bo@mail.test,+65 6000 0000,SG,group,Green,5,2026-01-31,1,0,2026-01-30
"""

PAYMENTS_CSV = """\
payment_id,booking_id,amount,currency,payment_method,payment_status,gateway_code,processed_at,refund_amount,refund_at
P1,R1,SGD 270.00,SGD,CARD,SUCCESS,ok,2026-06-29 21:06:00,,
P2,R2,7350000,VND,CARD,refunded,ok,2026-06-30 07:46:00,3675000,2026-06-30 09:00:00
P3,R3,775000,IDR,WALLET,SUCCESS,ok,2026-06-28 12:31:00,0,
P4,R99,10,USD,CARD,FAILED,no,2026-06-30 10:00:00,0,
P5,,15,USD,CARD,SUCCESS,ok,2026-06-30 11:00:00,0,
P6,R7,432,SGD,CARD,SUCCESS,ok,yesterday,0,
P7,R9,980000,VND,CASH,SUCCESS,ok,2026-06-15 18:25:00,98000,2026-06-30 12:00:00
"""

CLICKSTREAM_CSV = """\
event_id,session_id,user_id,event_type,page_url,hotel_id,search_query,device_type,os,event_timestamp
E1,S1,C1,search,/find,,harbour,desktop,Linux,2026-06-29 20:50:00
E2,S1,C1,click,/find,H30,,desktop,Linux,2026-06-29 20:55:00
E3,S1,C1,page_view,/h30,H30,,desktop,Linux,2026-06-29 20:57:30
E4,S1,C1,booking_complete,/pay,H30,,desktop,Linux,2026-06-29 21:04:30
E5,S2,,page_view,/,,,tablet,iPadOS,2026-06-30 06:00:00
E6,S2,c2,Click,/h20,h20,,TABLET,iPadOS,2026-06-30 06:00:45
E7,S3,C1,page_view,/,,,kiosk,,2026-06-30 23:59:50
E8,,C1,page_view,/,,,kiosk,,2026-06-30 23:59:55
"""

HOTEL_FIELDS = (
    "hotel_id", "hotel_name", "hotel_tier", "star_rating", "city", "country", "region",
    "latitude", "longitude", "total_rooms", "facilities", "partner_since", "is_active",
)


def header(csv):
    return csv.split("\n", 1)[0]


def xml(root, tag, fields, rows):
    def record(row):
        return "".join(f"<{f}>{v}</{f}>" for f, v in zip(fields, row))

    return f"<{root}>" + "".join(f"\n<{tag}>{record(row)}</{tag}>" for row in rows) + f"\n</{root}>\n"


def put(root, source, date, name, text):
    folder = os.path.join(str(root), "raw", source, f"_batch_date={date}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def put_csv(root, source, date, like, lines):
    put(root, source, date, f"{source}.csv", "\n".join([header(like), *lines]) + "\n")


def land_day1(root):
    fields = header(BOOKINGS_CSV).split(",")
    put(root, "bookings", DAY1, "desk.csv", BOOKINGS_CSV)
    put(root, "bookings", DAY1, "agents.xml", xml("bookings", "booking", fields, _BOOKINGS_XML))
    put(root, "hotels", DAY1, "hotels.xml", xml("hotels", "hotel", HOTEL_FIELDS, HOTELS))
    put(root, "customers", DAY1, "customers.csv", CUSTOMERS_CSV)
    put(root, "payments", DAY1, "payments.csv", PAYMENTS_CSV)
    put(root, "clickstream", DAY1, "clickstream.csv", CLICKSTREAM_CSV)


def land_day2(root):
    put_csv(root, "bookings", DAY2, BOOKINGS_CSV, [
        "R7,H30,C5,Loft,2026-07-05,2026-07-08,432,SGD,cancel,mobile app,CARD,2026-06-30 09:00:00",
        'R11,H70,C1,Suite,2026-07-20,2026-07-22,"THB 3,600",THB,CONFIRMED,web,CARD,2026-07-01 08:00:20',
        "R12,H70,C1,Suite,2026-07-20,2026-07-21,80,EUR,CONFIRMED,walk-in,CASH,2026-07-01 12:00:00",
    ])
    grown = tuple("44" if f == "total_rooms" else v for f, v in zip(HOTEL_FIELDS, HOTELS[0]))
    put(root, "hotels", DAY2, "hotels.xml", xml("hotels", "hotel", HOTEL_FIELDS, (grown, HOTELS[2], NEW_HOTEL)))
    c1, c2, c3, c4, _ = CUSTOMERS_CSV.splitlines()[1:]
    put_csv(root, "customers", DAY2, CUSTOMERS_CSV, [
        c1, c2.replace(",Red,", ",Gold,"), c3, c4.replace(",,", ",pia@mail.test,"),
    ])
    put_csv(root, "payments", DAY2, PAYMENTS_CSV, [
        "P8,R11,3600,THB,CARD,SUCCESS,ok,2026-07-01 08:01:00,0,",
        "P3,R3,775000,IDR,WALLET,Refunded,ok,2026-06-28 12:31:00,775000,2026-07-01 09:00:00",
        "P9,R404,25500,VND,CASH,SUCCESS,ok,2026-07-01 10:00:00,0,",
    ])
    put_csv(root, "clickstream", DAY2, CLICKSTREAM_CSV, [
        "E9,S3,C1,booking_complete,/pay,H70,,kiosk,,2026-07-01 08:00:00",
        "E10,S4,,search,/find,,pier,phone,,2026-07-01 10:00:00",
        "E11,S4,,click,/h70,h70,,phone,,2026-07-01 10:05:00",
    ])
