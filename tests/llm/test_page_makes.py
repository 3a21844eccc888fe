"""Pages of many makes, written by hand before the generator of training pages knew any of them.

A block that begins with § belongs to the main text; the sign is taken out before the page is read. {p} is a
paragraph of full sentences, {s} a short sentence, {w} a few words.
"""

import random
import re

import pytest

from corvane.llm import html_extraction
from corvane.llm.html_blocks import blocks

PAGES = {
    "bootstrap": '<body><div class="container"><div class="row"><div class="col-md-8"><h1>§{w}</h1><p>§{p}</p><p>§{p}</p><p>§{p}</p></div><div class="col-md-4"><h4>{w}</h4><ul><li><a href="/a">{w}</a></li><li><a href="/b">{w}</a></li></ul></div></div></div></body>',
    "neutral wrappers": '<body><div class="wrap"><div class="page"><div class="row"><div class="col-8"><h1>§{w}</h1><p>§{p}</p><p>§{p}</p></div></div></div></div></body>',
    "hashed names": '<body><div id="root"><div class="css-1x2y3z"><h1>§{w}</h1><p>§{p}</p><p>§{p}</p><p>§{p}</p></div></div></body>',
    "no container": '<body><header><a href="/">{w}</a></header><p>§{p}</p><p>§{p}</p><p>§{p}</p><footer>{w}</footer></body>',
    "bare text": "§{p} {p} {p} {p}",
    "encyclopedia": '<body><div id="mw-head"><ul><li><a href="/x">{w}</a></li><li><a href="/y">{w}</a></li></ul></div><div id="mw-content-text"><h1>§{w}</h1><p>§{p}</p><h2>§{w}</h2><dl><dt>§{w}</dt><dd>§{s}</dd><dt>§{w}</dt><dd>§{p}</dd></dl><pre>§{s}</pre><p>§{p}</p></div><div id="footer"><ul><li>{w}</li></ul></div></body>',
    "figures": '<body><nav><a href="/">{w}</a></nav><article><h1>§{w}</h1><figure><img src="a.png"><figcaption>§{w}</figcaption></figure><p>§{p}</p><figure><img src="b.png"><figcaption>§{p}</figcaption></figure><p>§{p}</p></article><footer><p>{w}</p></footer></body>',
    "weblog": '<body><div id="page" class="site"><header id="masthead"><p class="site-title"><a href="/">{w}</a></p><nav><ul><li><a href="/1">{w}</a></li><li><a href="/2">{w}</a></li></ul></nav></header><div id="content"><main><article class="post"><h1 class="entry-title">§{w}</h1><div class="entry-content"><p>§{p}</p><p>§{p}</p><ul><li>§{s}</li><li>§{s}</li></ul><p>§{p}</p></div></article></main><aside class="widget-area"><h2>{w}</h2><ul><li><a href="/3">{w}</a></li></ul></aside></div><footer>{w}</footer></div></body>',
    "manual": '<body><div class="sphinxsidebar"><h3>{w}</h3><ul><li><a href="/1">{w}</a></li><li><a href="/2">{w}</a></li><li><a href="/3">{w}</a></li></ul></div><div class="document"><div class="body"><section><h1>§{w}</h1><p>§{p}</p><pre>§{s}</pre><p>§{p}</p><table><tr><th>§{w}</th><th>§{w}</th></tr><tr><td>§{w}</td><td>§{s}</td></tr></table></section></div></div></body>',
    "hosted blog": '<body><div class="header-outer"><h1><a href="/">{w}</a></h1></div><div class="post-outer"><h3 class="post-title">§{w}</h3><div class="post-body"><p>§{p}</p><p>§{p}</p></div></div><div class="sidebar"><h2>{w}</h2><ul><li><a href="/1">{w}</a></li><li><a href="/2">{w}</a></li></ul></div></body>',
    "table layout": '<body><table width="100%"><tr><td bgcolor="#ccc"><a href="/1">{w}</a><br><a href="/2">{w}</a></td><td><font size="4"><b><p>§{w}</p></b></font><p>§{p}</p><p>§{p}</p><p>§{p}</p></td></tr></table></body>',
    "readme": '<body><header role="banner"><a href="/">{w}</a></header><div class="Box"><article class="markdown-body"><h1>§{w}</h1><p>§{p}</p><h2>§{w}</h2><ul><li>§{s}</li><li>§{w}</li></ul><pre>§{s}</pre><p>§{p}</p></article></div><footer><ul><li><a href="/t">{w}</a></li></ul></footer></body>',
    "recipe": '<body><nav><ul><li><a href="/1">{w}</a></li><li><a href="/2">{w}</a></li></ul></nav><div class="recipe"><h1>§{w}</h1><p>§{p}</p><h2>§{w}</h2><ul><li>§{w}</li><li>§{w}</li><li>§{w}</li></ul><ol><li>§{s}</li><li>§{p}</li></ol></div><div class="related"><h3>{w}</h3><ul><li><a href="/3">{w}</a></li><li><a href="/4">{w}</a></li></ul></div></body>',
    "mail archive": "<body><pre>§{p} {p} {p}</pre></body>",
    "deep sections": '<body><div><div><a href="/">{w}</a></div><section><div><div><h1>§{w}</h1><p>§{p}</p><p>§{p}</p><h2>§{w}</h2><p>§{p}</p></div></div></section></div><footer><a href="/a">{w}</a></footer></body>',
    "glossary": '<body><header><h1><a href="/">{w}</a></h1></header><div class="inner"><h2>§{w}</h2><dl><dt>§{w}</dt><dd>§{p}</dd><dt>§{w}</dt><dd>§{p}</dd><dt>§{w}</dt><dd>§{p}</dd></dl></div><div class="legal"><p>{w}</p></div></body>',
    "statute": "<body><h1>§{w}</h1><ol><li>§{p}</li><li>§{p}</li><li>§{s}</li></ol><h2>§{w}</h2><ol><li>§{p}</li><li>§{p}</li></ol></body>",
    "questions": '<body><div class="topnav"><a href="/1">{w}</a> <a href="/2">{w}</a></div><div class="faq"><h1>§{w}</h1><h2>§{w}?</h2><p>§{p}</p><h2>§{w}?</h2><p>§{p}</p><h2>§{w}?</h2><p>§{p}</p></div><div class="footer">{w}</div></body>',
    "hand-made": '<body bgcolor="white"><p><a href="/1">{w}</a> | <a href="/2">{w}</a> | <a href="/3">{w}</a></p><hr><h1>§{w}</h1><p>§{p}</p><p>§{p}</p><p>§{p}</p><hr><p><a href="/">{w}</a></p></body>',
    "lines": "<body><center><h2>§{w}</h2></center><p>§{p}<br><br>{p}<br><br>{p}</p></body>",
    "application": '<body><div id="__next"><div class="layout"><header class="top"><a href="/">{w}</a></header><main><h1>§{w}</h1><p>§{p}</p><p>§{p}</p><blockquote>§{p}</blockquote></main><footer>{w}</footer></div></div></body>',
    "utility classes": '<body><div class="flex min-h-screen"><div class="w-64"><ul><li><a href="/1">{w}</a></li><li><a href="/2">{w}</a></li><li><a href="/3">{w}</a></li></ul></div><div class="flex-1 p-6"><h1 class="text-2xl">§{w}</h1><p class="mt-4">§{p}</p><p class="mt-4">§{p}</p><p class="mt-4">§{p}</p></div></div></body>',
    "notice first": '<body><div class="cookie-consent"><p>{s}</p><button>{w}</button></div><div><h1>§{w}</h1><p>§{p}</p><p>§{p}</p></div><div class="newsletter"><form><label>{w}</label><button>{w}</button></form></div></body>',
    "thread below": '<body><div><h1>§{w}</h1><p>§{p}</p><p>§{p}</p><p>§{p}</p></div><div id="comments"><h3>{w}</h3><div class="comment"><p>{s}</p></div><div class="comment"><p>{p}</p></div></div></body>',
    "interview": '<body><nav><a href="/">{w}</a></nav><main><h1>§{w}</h1><p><strong>§{s}</strong></p><p>§{p}</p><p><strong>§{s}</strong></p><p>§{p}</p><p><strong>§{s}</strong></p><p>§{p}</p></main></body>',
    "tables": '<body><section><h2>§{w}</h2><p>§{p}</p><table><tr><td>§{w}</td><td>§{w}</td><td>§{w}</td></tr><tr><td>§{w}</td><td>§{w}</td><td>§{w}</td></tr></table><p>§{p}</p></section></body>',
    "paper": '<body><div class="ltx_page_main"><div class="ltx_page_content"><h1>§{w}</h1><div class="abstract"><p>§{p}</p></div><section><h2>§{w}</h2><p>§{p}</p><p>§{p}</p><figure><figcaption>§{s}</figcaption></figure><p>§{p}</p></section></div></div></body>',
    "essay": '<body><div class="wrapper"><h1>§{w}</h1><p>§{p}</p><blockquote><p>§{p}</p></blockquote><p>§{p}</p><hr><p>§{p}</p><p>§{p}</p></div></body>',
    "node": '<body><div class="region region-header"><div class="block"><a href="/">{w}</a></div></div><div class="region region-main"><div class="node"><h2>§{w}</h2><div class="field"><p>§{p}</p><p>§{p}</p><p>§{p}</p></div></div></div><div class="region region-footer"><div class="block"><p>{w}</p></div></div></body>',
    "advert inside": '<body><header><nav><ul><li><a href="/1">{w}</a></li><li><a href="/2">{w}</a></li></ul></nav></header><div class="article"><h1>§{w}</h1><p>§{p}</p><p>§{p}</p><div class="ad-slot"><p>{w}</p></div><p>§{p}</p><p>§{p}</p></div></body>',
    "grid": '<body><div class="grid"><aside class="cell"><ul><li><a href="/1">{w}</a></li><li><a href="/2">{w}</a></li></ul></aside><div class="cell"><h1>§{w}</h1><p>§{p}</p><h2>§{w}</h2><p>§{p}</p><pre><code>§{s}</code></pre></div></div></body>',
    "letter": "<html><body><div><div><div><p>§{s}</p><p>§{p}</p><p>§{p}</p><p>§{p}</p><p>§{w}</p></div></div></div></body></html>",
}

VOCABULARY = (
    "the a of and in to which river council harbour report winter season engine letter garden market teacher village minister coast study method "
    "library bridge signal archive measure field station record island was were had began found between under after several early quiet public "
    "narrow broken common northern second small careful"
).split()


def filled(template: str, seed: int) -> str:
    draw = random.Random(seed)

    def words(low: int, high: int) -> str:
        return " ".join(draw.choices(VOCABULARY, k=draw.randint(low, high))).capitalize()

    made = {"p": lambda: " ".join(words(9, 18) + "." for _ in range(draw.randint(2, 4))), "s": lambda: words(6, 12) + ".", "w": lambda: words(2, 4)}
    return re.sub(r"\{([psw])\}", lambda m: made[m[1]](), template)


def read(page: str) -> tuple[list[bool], list[bool], list[str]]:
    """(whether each block is main text, what the labeller says, texts)."""
    marked, plain = blocks(page), blocks(page.replace("§", ""))
    labels = html_extraction.label_pages([plain], html_extraction.train())[0]
    assert len(marked) == len(plain)
    return [b.text.startswith("§") for b in marked], labels.tolist(), [b.text for b in plain]


@pytest.mark.parametrize("seed", [1, 2])
def test_few_blocks_of_any_make_are_wrong(seed):
    wrong = total = 0
    for template in PAGES.values():
        want, got, _ = read(filled(template, seed))
        total += len(want)
        wrong += sum(a != b for a, b in zip(want, got, strict=True))
    assert wrong <= 0.03 * total


@pytest.mark.parametrize("name", PAGES)
def test_no_page_with_an_article_is_left_empty(name):
    want, got, texts = read(filled(PAGES[name], 3))
    if sum(t.count(".") for w, t in zip(want, texts, strict=True) if w) > 3:
        assert any(a and b for a, b in zip(want, got, strict=True))


if __name__ == "__main__":
    for name, template in PAGES.items():
        for seed in (1, 2):
            want, got, texts = read(filled(template, seed))
            bad = [("-" if w else "+", t[:25]) for w, g, t in zip(want, got, texts, strict=True) if w != g]
            print(name, seed, f"{len(bad)}/{len(want)}", bad[:4])
