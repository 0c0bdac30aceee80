"""Hosts against other implementations of their parts, and literal cases of a browser's parser."""

import ipaddress
import random

from mentionflow.functions import url as U

from .test_expressions import column


def test_punycode(spark):
    from pyspark.sql import functions as F

    from mentionflow.functions.hosts import punycode

    rng = random.Random(5)
    labels = ["münchen", "bücher", "例え", "пример", "ñandú", "日本語テスト", "fußball", "ελληνικά", "한국어", "🎉", "a🎉b", "ünïcödé-x", "éé", "eé0", "中a国", "𝒳y"]
    labels += ["".join(rng.choice("abc-019éüß日本語пример🎉ñ") for _ in range(rng.randrange(1, 40))) for _ in range(120)]
    labels = [x for x in labels if not x.isascii()]
    assert column(spark, labels, punycode(F.col("v"))) == [x.encode("punycode").decode() for x in labels]


def test_ipv4(spark):
    rng, cases = random.Random(6), {}
    for _ in range(60):
        v = rng.choice([rng.randrange(1 << 32), rng.randrange(1 << 16), 0, (1 << 32) - 1])
        write = lambda x: rng.choice([str(x), hex(x), hex(x).upper().replace("0X", "0x"), "0" + oct(x)[2:], "0x00" + hex(x)[2:]])
        b = [v >> 24, v >> 16 & 255, v >> 8 & 255, v & 255]
        text = rng.choice([write(v), f"{write(b[0])}.{write(v & 0xFFFFFF)}", f"{write(b[0])}.{write(b[1])}.{write(v & 0xFFFF)}", ".".join(map(write, b))])
        cases[f"http://{text}{rng.choice(['', '.', ':80', ':8080'])}/"] = str(ipaddress.IPv4Address(v))
    cases |= dict.fromkeys(["http://256.1.1.1/", "http://1.2.3.4.5/", "http://1.2.3/x".replace("3/x", "65536/x"), "http://4294967296/", "http://0x1ffffffff/", "http://08/", "http://1..2/", "http://a.1/", "http://09.1/", "http://1.2.3.4a5.0x/".replace("4a5.0x", "b.7"), "http://1e3.9/"], "")
    cases |= {"http://0x/": "0.0.0.0", "http://0x7f.1/": "127.0.0.1", "http://1.2.3.4a/": "1.2.3.4a", "http://017700000001/": "127.0.0.1", "http://１２７.0.0.1/": "127.0.0.1", "http://%31%32.1/": "12.0.0.1"}
    assert column(spark, list(cases), U.host("v")) == list(cases.values())


def test_ipv6(spark):
    rng, cases = random.Random(7), {}
    for _ in range(80):
        pieces = [rng.choice([0, 0, 0, rng.randrange(1 << 16), rng.randrange(16)]) for _ in range(8)]
        want = ipaddress.IPv6Address(":".join(f"{p:x}" for p in pieces)).compressed
        text = rng.choice([":".join(f"{p:x}" for p in pieces), ":".join(f"{p:04X}" for p in pieces), want, ":".join(f"{p:x}" for p in pieces[:6]) + f":{pieces[6] >> 8}.{pieces[6] & 255}.{pieces[7] >> 8}.{pieces[7] & 255}"])
        cases[f"https://[{text}]{rng.choice(['', ':443', ':80'])}/"] = f"[{want}]"
    cases |= dict.fromkeys(["http://[::1/", "http://[1::2::3]/", "http://[1:2:3:4:5:6:7]/", "http://[1:2:3:4:5:6:7:8:9]/", "http://[12345::]/", "http://[:1:2:3:4:5:6:7]/", "http://[::1.2.3]/", "http://[::1.2.3.256]/", "http://[::01.2.3.4]/", "http://[g::]/", "http://[]/", "http://[::1]x/", "http://[1:2:3:4:5:6:7:]/", "http://[:::1]/"], "")
    cases |= {"http://[::]/": "[::]", "http://[::1]:80/a": "[::1]", "http://[1::]/": "[1::]", "http://[::ffff:1.2.3.4]/": "[::ffff:102:304]"}
    assert column(spark, list(cases), U.host("v")) == list(cases.values())


def test_hosts_and_ports(spark):
    cases = {
        "https://ex%61mple.com/": "https://example.com/", "http:/ex.com/a": "http://ex.com/a", "http:\\\\ex.com\\a": "http://ex.com/a", "http:ex.com/a": "http://ex.com/a", "HTTP:////EX.com/a\\b": "http://ex.com/a/b", "https:\\/ex.com": "https://ex.com/",
        "http://EX.com:080/": "http://ex.com/", "https://ex.com:99999/": "", "https://ex.com:65535/": "https://ex.com:65535/", "https://ex.com:65536/": "", "https://ex.com:0/": "https://ex.com:0/", "http://ex.com:/": "http://ex.com/", "http://ex.com:0443/": "http://ex.com:443/", "https://ex.com:00443/": "https://ex.com/",
        "https://ex.com:8a/": "", "http://[::1]:80/a": "http://[::1]/a", "https://münchen.de/x": "https://xn--mnchen-3ya.de/x", "https://BÜCHER.example:443": "https://xn--bcher-kva.example/", "https://例え.テスト/": "https://xn--r8jz45g.xn--zckzah/", "https://ＥＸ．com/": "https://ex.com/", "https://a。b/": "https://a.b/",
        "https://faß.de/": "https://xn--fa-hia.de/", "https://a%2Fb.com/": "", "https://a%00b.com/": "", "https://a%20b.com/": "", "https://%zz.com/": "", "https://a<b.com/": "", "https://a^b.com/": "", "https://a|b.com/": "", "https://a_b.com/": "https://a_b.com/", "https://a..b/": "https://a..b/", "https://ex.com./": "https://ex.com./",
        "https:///": "", "https://": "", "http://user:p@ss@ex.com/": "http://user:p@ss@ex.com/", "ftp://ex.com:21/a/": "ftp://ex.com/a", "ws://ex.com:80/": "ws://ex.com/", "wss://ex.com:443/x": "wss://ex.com/x", "http://x\u00ady.com/": "http://xy.com/", "http://a@b@c.com/": "http://a@b@c.com/", "http://%C3%BC.com/": "http://xn--tda.com/",
        "http://ex.com:80:80/": "", "http://-a.com/": "http://-a.com/", "http://1.com/": "http://1.com/", "http://a.b.c.1x/": "http://a.b.c.1x/", "http://ex.com?x=1": "http://ex.com/?x=1", "http://ex.com#f": "http://ex.com/#f", "http:?x": "", "https://xn--mnchen-3ya.de/": "https://xn--mnchen-3ya.de/", "http://a`b{c}.com/": "http://a`b{c}.com/",
    }
    got = column(spark, list(cases), U.normalized("v"))
    assert dict(zip(cases, got, strict=True)) == cases
    again = column(spark, got, U.normalized("v"))
    assert again == got
