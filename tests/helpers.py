import datetime as dt

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def ts(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


EVENT_SCHEMA = ("event_time timestamp_ntz, event_type string, product_id long, category_id long, "
                "category_code string, brand string, price double, user_id long, user_session string")


def events(spark, rows):
    """rows: (seconds, type, product, user, session[, price, category_code, brand])"""
    full = []
    for r in rows:
        sec, typ, prod, user, sess = r[:5]
        price = r[5] if len(r) > 5 else 10.0
        cat = r[6] if len(r) > 6 else "a.b"
        brand = r[7] if len(r) > 7 else "x"
        full.append((ts(sec), typ, prod, 1, cat, brand, price, user, sess))
    return spark.createDataFrame(full, EVENT_SCHEMA)
