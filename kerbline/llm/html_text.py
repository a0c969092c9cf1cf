"""Main text of web pages by a recurrent block labeller.

A page is cut into blocks, the leaf sequence of its tags: runs of text between block-level tags, with the path of open tags
(names, and the words of class, id and role). Scripts, styles, templates and comments are markup, not blocks. Every block
becomes a vector of hashed path features, hashed words and a few counts; a bidirectional LSTM in numpy reads the sequence
of the whole page and labels each block as main text or not.

Training uses a bounded sample: ``SAMPLE`` pages of at most ``SAMPLE_CHARS`` characters, by the hash of their ids; of longer
pages, if there are no others, the middle. Their blocks are labelled by meaning: inside ``article`` or ``main`` is main text,
inside the tags and class words of the lists below is not. On a page without either tag the blocks outside such tags and
words count by how much they look like prose. To meet other layouts than the sample's own, each page is also set anew
``VARIANTS`` times: its main text in a random container, named or not, as paragraphs, lists, quotations, tables and plain
blocks, with other blocks of the sample around and between as menus, notices, forms, sidebars and comments. It takes some
tens of seconds on the driver, whatever the number of pages.

Edge cases: a null or empty page, or one without main text, gives an empty string; unclosed and misnested tags close as in
browsers' usual cases; what stands in unknown tags, in ``svg``, ``math`` or ``object`` is read like any text, and only scripts,
styles, templates and what replaces or feeds them is skipped; a repeated page is read again; where no page has any text
there is nothing to learn or to label; pages of any length are read whole; further columns are kept, but for ``text`` and
``n_chars``.
"""

import html
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kerbline.llm.buffers import LOWER, SYMBOL_CODES, Hasher, mix, word_bounds
from kerbline.llm.frames import fresh, mapped, schema_with

SAMPLE, SAMPLE_CHARS, VARIANTS, SEED = 320, 20_000, 4, 7
PATH_BINS, WORD_BINS, COUNTS, HIDDEN = 96, 24, 9, 20
EPOCHS, BATCH, RATE = 16, 32, 0.02
CELLS = 1 << 16
PROSE_WORDS = 12
MARK = "\x01"

#: Block-level elements, elements without content, and elements whose content is not text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup "
    "option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
EMPTY_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style template noscript iframe textarea".split())
#: What an opening tag closes if it is open inside the nearest container.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
CONTAINERS = frozenset("article aside body div section main td th table ul ol dl form nav header footer blockquote fieldset".split())

#: What sets blocks apart from the main text, as tags and as words of class, id and role.
OTHER_TAGS = frozenset("aside button dialog footer form header label legend menu nav option search select title".split())
OTHER_WORDS = frozenset(
    "ad ads advert advertisement adverts alert author-box banner bio breadcrumb breadcrumbs byline-box comment comments consent "
    "cookie cookies copyright disqus feedback footer form gdpr header login masthead menu meta modal nav navbar navigation "
    "newsletter notice notification pager pagination popup promo promoted recommended related replies reply respond search "
    "share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar topbar trending widget".split()
)
MAIN_TAGS = frozenset(("article", "main"))
MAIN_WORDS = ("content", "article", "post", "entry", "story", "body", "main", "text")

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z0-9]+")
#: Words and signs that a page says about itself.
_FURNITURE = re.compile(
    r"©|\(c\) ?\d{4}|\b(copyright|all rights reserved|privacy|terms of (use|service)|cookies?|subscribe|newsletter|log ?in|sign (in|up)|"
    r"share (this|on)|advertis\w+|related (posts|articles)|read more|leave a (comment|reply))\b",
    re.I,
)


def _features(tag, attributes):
    """Path features of one open tag."""
    words = []
    if "=" in attributes:
        for _, a, b, c in _ATTRIBUTE.findall(attributes):
            words += _WORD.findall((a or b or c).lower())
    return (tag, *("." + w for w in words))


def blocks(page):
    """[(path, text, characters inside links)] of a page; the path is a tuple of features for each open tag."""
    out, stack, buffer = [], [], []
    path, links, first = (), 0, None

    def flush():
        nonlocal links, first
        if first is not None:
            text = " ".join("".join(buffer).split())
            if text:
                out.append((first, text, links))
        buffer.clear()
        links, first = 0, None

    def add(raw):
        nonlocal links, first
        text = html.unescape(raw) if "&" in raw else raw
        buffer.append(text)
        if first is None and text.strip():
            first = path
        if stack and "a" in stack:
            links += len(text)

    at = 0
    while True:
        match = _TAG.search(page, at)
        if match is None:
            add(page[at:])
            break
        if match.start() > at:
            add(page[at : match.start()])
        at = match.end()
        close, tag, attributes = match.group(1, 2, 3) if match.group(2) else match.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if tag in BLOCK_TAGS:
            flush()
        if close:
            if tag in stack:
                i = len(stack) - 1 - stack[::-1].index(tag)
                del stack[i:]
                path = path[:i]
            continue
        if tag in RAW_TAGS:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in EMPTY_TAGS:
            continue
        closing = CLOSES.get(tag, ()) + (("p",) if tag in BLOCK_TAGS else ())
        for i in range(len(stack) - 1, -1, -1):
            if stack[i] in closing:
                del stack[i:]
                path = path[:i]
                break
            if stack[i] in CONTAINERS:
                break
        stack.append(tag)
        path = (*path, _features(tag, attributes))
    flush()
    return out


def label(path):
    """1 inside article or main and in nothing that sets blocks apart, else 0."""
    inside = 0
    for features in path:
        tag, words = features[0], [w[1:] for w in features[1:]]
        if tag in MAIN_TAGS:
            inside = 1
        elif tag in OTHER_TAGS or any(w in OTHER_WORDS for w in words):
            return 0
    return inside


def prose_labels(found):
    """Labels of a page without article or main, from how its blocks look: outside the tags and words that set blocks apart,
    prose is main text, and so is what stands among prose under the same parent."""
    apart = [any(f[0] in OTHER_TAGS or any(w[1:] in OTHER_WORDS for w in f[1:]) for f in path) for path, _, _ in found]
    prose = [
        not out and len(text.split()) >= PROSE_WORDS and 3 * links < len(text) and text[-1:] in ".!?:\"'”»"
        for out, (_, text, links) in zip(apart, found)
    ]
    parents = {path[:-1] for flag, (path, _, _) in zip(prose, found) if flag}
    spots = [i for i, flag in enumerate(prose) if flag]
    low, high = (spots[0], spots[-1]) if spots else (0, -1)
    among = [low <= i <= high and not out and path[:-1] in parents for i, (out, (path, _, _)) in enumerate(zip(apart, found))]
    return [int(x or y) for x, y in zip(prose, among)]


def labels_of(found):
    """Weak label of each block of a page."""
    own = [label(path) for path, _, _ in found]
    return own if any(own) else prose_labels(found)


def _container(rng, kind):
    """Opening and closing tags around main text or other blocks; names are drawn from the lists above."""

    def pick(values):
        return values[int(rng.integers(len(values)))]

    if kind == "main":
        tag = pick(("article", "main", "div", "div", "section", "td"))
        words = "-".join(pick(MAIN_WORDS) for _ in range(int(rng.integers(1, 3))))
        named = rng.random() < (0.5 if tag in MAIN_TAGS else 0.35)
        return f"<{tag}>" if named else f'<{tag} {pick(("class", "id"))}="{words}">', f"</{tag}>"
    tag = pick(("div", "div", "section", "ul", "aside", "nav", "header", "footer", "form"))
    if rng.random() < (0.5 if tag in OTHER_TAGS else 0.1):
        return f"<{tag}>", f"</{tag}>"
    word = pick(sorted(OTHER_WORDS))
    word = pick((word, f"{word}-{pick(('box', 'list', 'top', 'item', 'area'))}", f"{pick(('site', 'page', 'block'))}-{word}"))
    return f'<{tag} {pick(("class", "id"))}="{word}">', f"</{tag}>"


def _set_main(text, rng, heading):
    """A block of main text as HTML; every leaf begins with ``MARK``, so that labels follow blocks through the parser."""

    def leaf(tag, words):
        return f"<{tag}>{html.escape(MARK + ' '.join(words))}</{tag}>"

    words = text.split()
    if heading:
        return leaf(("h1", "h1", "h2", "h3")[int(rng.integers(4))], words)
    cuts = sorted({0, len(words), *(int(x) for x in rng.integers(0, len(words) + 1, int(rng.integers(1, 5))))})
    pieces = [words[a:b] for a, b in zip(cuts, cuts[1:])]
    kind = rng.random()
    if kind < 0.50:
        return leaf("p", words)
    if kind < 0.66:
        tag = ("ul", "ol")[int(rng.integers(2))]
        return f"<{tag}>" + "".join(leaf("li", w[:12] if rng.random() < 0.5 else w) for w in pieces) + f"</{tag}>"
    if kind < 0.74:
        return "<blockquote>" + (leaf("p", words) if rng.random() < 0.5 else html.escape(MARK + text)) + "</blockquote>"
    if kind < 0.79:
        return leaf("pre", words)
    if kind < 0.84:
        return "<table><tr>" + "".join(leaf("td", w) for w in pieces) + "</tr></table>"
    if kind < 0.88:
        return "<dl>" + "".join(leaf(("dt", "dd")[i % 2], w) for i, w in enumerate(pieces)) + "</dl>"
    if kind < 0.93:
        return leaf(("h2", "h3", "h4")[int(rng.integers(3))], words[:8]) + (leaf("p", words[8:]) if words[8:] else "")
    return leaf("div", words)


def variant(main, others, rng):
    """A page set anew around main text blocks, which begin with ``MARK``, with other blocks around and between."""

    def setting(text, inner):
        return f"<{inner}>{html.escape(text)}</{inner}>"

    def around():
        start, end = _container(rng, "other")
        inner = ("p", "li", "div", "label", "h3", "span", "p")[int(rng.integers(7))]
        chosen = [others[int(rng.integers(len(others)))] for _ in range(int(rng.integers(1, 6)))] if others else []
        if main and rng.random() < 0.3:  # comments and teasers read like main text
            chosen.append(main[int(rng.integers(len(main)))])
        link = rng.random() < 0.4
        return start + "".join(f"<a href='#'>{setting(t, inner)}</a>" if link else setting(t, inner) for t in chosen) + end

    open_main, close_main = _container(rng, "main")
    marked = [_set_main(t, rng, not i and rng.random() < 0.7) for i, t in enumerate(main)]
    while rng.random() < 0.5:
        marked.insert(int(rng.integers(len(marked) + 1)), around())
    before = "".join(around() for _ in range(int(rng.integers(0, 4))))
    after = "".join(around() for _ in range(int(rng.integers(0, 4))))
    wrap = rng.random() < 0.5
    core = open_main + "".join(marked) + close_main
    return f"<html><body>{before}{'<div>' if wrap else ''}{core}{'</div>' if wrap else ''}{after}</body></html>"


def _bin(text, bins):
    code = zlib.crc32(text.encode())
    return code % bins, 1.0 if code >> 31 else -1.0


class Reader:
    """Vectors of blocks."""

    def __init__(self):
        self.paths, self.tags = {}, {}

    def path(self, path):
        if path not in self.paths:
            if len(self.paths) > 50_000:
                self.paths.clear()
            vector = np.zeros(PATH_BINS, np.float32)
            for depth, features in enumerate(path):
                for name in features:
                    for kind in (name, f"{name}^") if depth >= len(path) - 2 else (name,):
                        spot, sign = _bin(kind, PATH_BINS)
                        vector[spot] += sign
            self.paths[path] = np.clip(vector, -2, 2)
        return self.paths[path]

    def vectors(self, found):
        """(n, features) of a list of blocks of one or more pages."""
        n = len(found)
        out = np.zeros((n, PATH_BINS + WORD_BINS + COUNTS), np.float32)
        if not n:
            return out
        raws = [text.encode("utf-8", "surrogatepass") for _, text, _ in found]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raws])])
        data = LOWER[np.frombuffer(b"".join(raws), np.uint8)]
        starts, ends, rows = word_bounds(data, offsets)
        codes = mix(Hasher(SYMBOL_CODES[data]).of(starts, ends))
        sign = np.where(codes >> np.uint64(63), 1.0, -1.0)
        cells = rows * WORD_BINS + (codes % np.uint64(WORD_BINS)).astype(np.int64)
        words = np.bincount(cells, weights=sign, minlength=n * WORD_BINS).reshape(n, WORD_BINS)
        number = np.bincount(rows, minlength=n)
        out[:, :PATH_BINS] = [self.path(path) for path, _, _ in found]
        out[:, PATH_BINS : PATH_BINS + WORD_BINS] = np.clip(words / np.sqrt(np.maximum(number, 1))[:, None], -2, 2)
        size = np.diff(offsets)
        per = np.maximum(size, 1)
        row = np.repeat(np.arange(n), size)

        def share(flags):
            return np.bincount(row, weights=flags, minlength=n) / per

        counts = out[:, PATH_BINS + WORD_BINS :]
        counts[:, 0] = np.log1p(number) / 4
        counts[:, 1] = np.minimum(number, 20) / 20
        counts[:, 2] = [min(1.0, links / max(1, len(text))) for _, text, links in found]
        counts[:, 3] = share((data == 46) | (data == 44)) * 20
        counts[:, 4] = share((data >= 48) & (data < 58)) * 5
        counts[:, 5] = [text[-1:] in ".!?" for _, text, _ in found]
        counts[:, 6] = [len(path) / 10 for path, _, _ in found]
        counts[:, 7] = 1
        counts[:, 8] = [len(text) < 400 and _FURNITURE.search(text) is not None for _, text, _ in found]
        return out


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class Labeller:
    """Bidirectional LSTM with a logistic output on both states and the block's own vector."""

    def __init__(self, size, hidden=HIDDEN, seed=SEED):
        rng = np.random.default_rng(seed)
        self.hidden, self.p = hidden, {}
        for way in "fb":
            self.p[f"{way}x"] = rng.normal(0, size**-0.5, (size, 4 * hidden)).astype(np.float32)
            self.p[f"{way}h"] = rng.normal(0, hidden**-0.5, (hidden, 4 * hidden)).astype(np.float32)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden : 2 * hidden] = 1
            self.p[f"{way}c"] = bias
            self.p[f"{way}o"] = rng.normal(0, hidden**-0.5, hidden).astype(np.float32)
        self.p["o"], self.p["oc"] = np.zeros(size, np.float32), np.zeros(1, np.float32)

    def _pass(self, way, x, mask):
        """States (time, pages, hidden) of one direction, and what the backward step needs."""
        steps, pages, _ = x.shape
        n = self.hidden
        inputs = x @ self.p[f"{way}x"] + self.p[f"{way}c"]
        h, c = np.zeros((pages, n), np.float32), np.zeros((pages, n), np.float32)
        states, memory = np.zeros((steps, pages, n), np.float32), []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = inputs[t] + h @ self.p[f"{way}h"]
            gates, g = _sigmoid(z[:, : 3 * n]), np.tanh(z[:, 3 * n :])
            i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
            new = f * c + i * g
            th = np.tanh(new)
            m = mask[t][:, None]
            memory.append((t, i, f, o, g, th, c, h, m))
            c, h = np.where(m, new, c), np.where(m, o * th, h)
            states[t] = h
        return states, memory

    def logits(self, x, mask):
        """(time, pages) logits of (time, pages, features), and what the backward step needs."""
        forward, fm = self._pass("f", x, mask)
        backward, bm = self._pass("b", x, mask)
        out = forward @ self.p["fo"] + backward @ self.p["bo"] + x @ self.p["o"] + self.p["oc"]
        return out, (forward, fm, backward, bm)

    def gradients(self, x, mask, labels):
        out, (forward, fm, backward, bm) = self.logits(x, mask)
        error = ((_sigmoid(out) - labels) * mask / max(1, mask.sum())).astype(np.float32)
        grad = {"o": np.einsum("tp,tpd->d", error, x), "oc": error.sum(keepdims=True).ravel()}
        n = self.hidden
        for way, states, memory in (("f", forward, fm), ("b", backward, bm)):
            grad[f"{way}o"] = np.einsum("tp,tph->h", error, states)
            dz_all = np.zeros((*mask.shape, 4 * n), np.float32)
            dh, dc = np.zeros_like(states[0]), np.zeros_like(states[0])
            gh = np.zeros_like(self.p[f"{way}h"])
            for t, i, f, o, g, th, c, h, m in reversed(memory):
                dh = dh + error[t][:, None] * self.p[f"{way}o"]
                own_h = dh * m
                d = dc * m + own_h * o * (1 - th * th)
                dz = np.concatenate([d * g * i * (1 - i), d * c * f * (1 - f), own_h * th * o * (1 - o), d * i * (1 - g * g)], 1)
                dz_all[t] = dz
                gh += h.T @ dz
                dh = dh * ~m + dz @ self.p[f"{way}h"].T
                dc = dc * ~m + d * f
            flat = dz_all.reshape(-1, 4 * n)
            grad[f"{way}x"] = x.reshape(-1, x.shape[2]).T @ flat
            grad[f"{way}h"], grad[f"{way}c"] = gh, flat.sum(0)
        return grad

    def fit(self, pages, epochs=EPOCHS, rate=RATE, seed=SEED):
        """Adam over batches of pages of similar length; pages are (vectors, labels)."""
        rng = np.random.default_rng(seed)
        order = sorted(range(len(pages)), key=lambda k: len(pages[k][1]))
        batches = [order[k : k + BATCH] for k in range(0, len(order), BATCH)]
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, total = 0, epochs * len(batches)
        for _ in range(epochs):
            for k in rng.permutation(len(batches)):
                x, mask = padded([pages[j][0] for j in batches[k]])
                labels = np.zeros(mask.shape, np.float32)
                for col, j in enumerate(batches[k]):
                    labels[: len(pages[j][1]), col] = pages[j][1]
                step += 1
                for name, g in self.gradients(x, mask, labels).items():
                    g = np.clip(g, -1, 1)
                    mean[name] = 0.9 * mean[name] + 0.1 * g
                    square[name] = 0.99 * square[name] + 0.01 * g * g
                    scale = np.sqrt(square[name] / (1 - 0.99**step)) + 1e-6
                    pace = rate * (1 - step / (total + 1)) / (1 - 0.9**step)
                    self.p[name] = (self.p[name] - pace * mean[name] / scale).astype(np.float32)
        return self


def padded(sequences):
    """(time, pages, features) and mask of sequences of different lengths."""
    steps = max(map(len, sequences))
    x = np.zeros((steps, len(sequences), sequences[0].shape[1]), np.float32)
    mask = np.zeros((steps, len(sequences)), bool)
    for i, s in enumerate(sequences):
        x[: len(s), i], mask[: len(s), i] = s, True
    return x, mask


def train(pages, sample=SAMPLE, variants=VARIANTS, seed=SEED):
    """The labeller trained on a bounded sample of ``pages`` (page_id, html); None if no page of it has any main text."""
    some = pages.where("html IS NOT NULL AND html <> ''")
    short = some.where(F.length("html") <= SAMPLE_CHARS)
    if short.where("page_id IS NOT NULL").isEmpty():
        middle = ((F.length("html") - SAMPLE_CHARS) / 2).cast("int")
        short = some.withColumn("html", F.substring("html", middle, F.lit(SAMPLE_CHARS)))
    ids = short.select("page_id").where("page_id IS NOT NULL").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    # ids first: ordering whole pages would send so many of them from every task
    chosen = [r["page_id"] for r in ids.collect()]
    rows = short.where(F.col("page_id").isin(chosen)).select("html").limit(2 * sample).collect() if chosen else []
    reader, rng, data, others, mains = Reader(), np.random.default_rng(seed), [], [], []
    for row in sorted(rows, key=lambda r: r["html"]):
        found = blocks(row["html"])
        labels = labels_of(found)
        if found and any(labels):
            data.append((reader.vectors(found), np.array(labels, np.float32)))
            mains.append([text for (_, text, _), y in zip(found, labels) if y])
            others += [text for (_, text, _), y in zip(found, labels) if not y]
    for _ in range(variants):
        for main in mains:
            found = blocks(variant(main, others, rng))
            labels = np.array([text.startswith(MARK) for _, text, _ in found], np.float32)
            found = [(path, text.removeprefix(MARK), links) for path, text, links in found]
            data.append((reader.vectors(found), labels))
    data = [d for d in data if len(d[1])]
    return Labeller(PATH_BINS + WORD_BINS + COUNTS, seed=seed).fit(data, seed=seed) if data else None


def main_texts(model, reader, pages):
    """Main text of each page."""
    found = [blocks(page) for page in pages]
    sizes = np.array([len(f) for f in found])
    vectors = reader.vectors(list(chain.from_iterable(found)))
    ends = np.cumsum(sizes)
    out = [""] * len(pages)
    order = [int(k) for k in np.argsort(sizes, kind="stable") if sizes[k]]
    at = 0
    while at < len(order):
        group = [order[at]]
        at += 1
        while at < len(order) and sizes[order[at]] * (len(group) + 1) <= max(CELLS, sizes[group[0]]):
            group.append(order[at])
            at += 1
        if model is None:
            keep = [np.array(labels_of(found[k]), bool) for k in group]
        else:
            x, mask = padded([vectors[ends[k] - sizes[k] : ends[k]] for k in group])
            logits = model.logits(x, mask)[0]
            keep = [logits[: sizes[k], col] > 0 for col, k in enumerate(group)]
        for k, flags in zip(group, keep):
            out[k] = " ".join(text for (_, text, _), flag in zip(found[k], flags) if flag)
    return out


def extract(pages, model):
    """Add text and n_chars to ``pages`` (column ``html``)."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # a few ten thousand weights
    (raw,) = fresh(pages, "raw")
    added = {"text": "string", "n_chars": "long"}
    own = [c for c in pages.columns if c.lower() not in added]
    plain = pages.select([f"`{c}`" for c in own])

    def run(batches):
        model, reader = shared.value, Reader()
        for batch in batches:
            for low in range(0, batch.num_rows, 250):
                part = batch.slice(low, 250)
                texts = main_texts(model, reader, part.column(raw).to_pylist())
                values = {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
                arrays = [*part.drop_columns([raw]).columns, *values.values()]
                yield pa.RecordBatch.from_arrays(arrays, [*own, *values])

    return mapped(plain.withColumn(raw, F.coalesce(F.col("html"), F.lit(""))), run, schema_with(plain, **added))
