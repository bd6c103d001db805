"""Multipart credentials as .env files write them: prefixes that end in "_", no space or quote after "="."""

from test_native import frame

from flowloom.llm.secret_scan import digest, secret_scan

KEY = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"


def found(spark, texts):
    rows = list(enumerate(texts))
    spans = {r.doc_id: r.spans.split(",") if r.spans else [] for r in digest(secret_scan(frame(spark, rows))).collect()}
    out = []
    for i, text in rows:
        each = [s.split(":") for s in spans[i]]
        out.append([(kind, text[int(a):int(b)]) for kind, a, b in each])
    return out


def test_env_files(spark):
    own = "AKIA" + "Q" * 16
    got = found(spark, [
        "DB_USER=alice DB_PWD=hunter22x DB_HOST=db.internal",
        f"AWS_ACCESS_KEY_ID={own}\nAWS_SECRET_ACCESS_KEY={KEY}",
        f"AWS_ACCESS_KEY_ID=ASIA77\nAWS_SECRET_ACCESS_KEY={KEY}",
        f"AWS_SECRET_ACCESS_KEY={KEY}",
        "APP_CLIENT_ID=77-aa\nAPP_PRIVATE_KEY=abc/def\nAPP_ENDPOINT=api.internal",
        "MY_LOGIN: bob MY_CREDENTIAL: s3cr3t99",
        "DB_USER=alice\n\nDB_PWD=hunter22x",
        "superuser=alice xpwd=hunter22x",
    ])
    assert got[0] == [("ident", "USER=alice"), ("key", "PWD=hunter22x"), ("url", "HOST=db.internal")]
    assert got[1] == [("access", own), ("key", KEY)]
    assert got[2] == [("ident", "ACCESS_KEY_ID=ASIA77"), ("key", KEY)]
    assert got[3] == []  # a secret alone; its name is not an identifier
    assert got[4] == [("ident", "CLIENT_ID=77-aa"), ("key", "PRIVATE_KEY=abc/def"), ("url", "ENDPOINT=api.internal")]
    assert got[5] == [("ident", "LOGIN: bob"), ("key", "CREDENTIAL: s3cr3t99")]
    assert got[6] == [] and got[7] == []
