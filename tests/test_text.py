"""C26 nested payloads and C28 intents on the specification's example sentences."""

from panelrank.operators.text import flatten_json, intent_bucket


def test_nested_payload_expands_to_leaves(spark):
    df = spark.createDataFrame([(1, '{"device": {"os": "x", "size": {"w": 2}}, "price": 1.25, "tags": ["a", "b"]}'), (2, "{}"), (3, None)], "id int, props string")
    out = flatten_json(df, "props", "device struct<os:string,size:struct<w:int,h:int>>, price decimal(10,2), tags array<string>").drop("props").orderBy("id")
    assert out.columns == ["id", "device_os", "device_size_w", "device_size_h", "price", "tags"]
    got = [tuple(r) for r in out.collect()]
    assert (got[0][1:4], str(got[0][4]), got[0][5]) == (("x", 2, None), "1.25", ["a", "b"]) and got[1][1:] == got[2][1:] == (None,) * 5


def test_intents_of_the_example_sentences(spark):
    said = {"magnesium taurate vs glycinate": "Comparison", "alternative to epsom salt": "Replacement", "is bath salt safe": "Risk/safety", "for sore muscles": "Use-case",
            "buy flewd soak": "Decision-stage", "house blue": "Other", "hotel forest": "Other", " ": "anonymized_privacy"}
    got = {r.q: r.intent for r in intent_bucket(spark.createDataFrame([(k,) for k in said], "q string"), "q").collect()}
    assert got == said
