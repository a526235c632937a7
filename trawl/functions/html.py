"""H1-H4: HTML text extraction as one Arrow batch step.

Spark has no HTML tree builder, so this is the single place where page
bodies are handed to Python, batch-wise through ``mapInArrow``: each task
gets Arrow record batches of ``(key, html)`` and returns
``(key, title, headers array<string>, paras array<string>)``.  Everything
before (line joining, filtering) and after (T1/T4/H5) runs natively.

Tree rules (those of a lenient, non-HTML5 tree builder over the stdlib
tokenizer, which is what the pipeline's results depend on):

* entities are unescaped and NFKC applied *before* parsing (H1), so an
  escaped ``&lt;p&gt;`` becomes a real tag;
* an end tag closes the nearest open element of that name and everything
  opened after it; an end tag with no open match is ignored;
* void elements (``br``, ``meta`` ...) never hold text;
* a text between two pieces of markup that is ASCII white space only becomes
  one newline if it has one, else one blank (not inside ``pre``, ``textarea``);
* the text of a ``CDATA`` section is text;
* text inside ``script``/``style``/``template``/``rt``/``rp`` and comments is
  not part of any element text;
* ``p_mode="nested"``: a ``<p>`` does not close an open ``p`` (text of inner
  paragraphs appears in the outer one too); ``p_mode="autoclose"``: a new
  ``<p>`` first closes the open ``p``;
* title = text of the first ``title`` when it has exactly one child (or one
  child tag whose own single child is text ...), else empty.
"""

from __future__ import annotations

import html as _html
import unicodedata
from html.parser import HTMLParser
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Element names of the tree rules above.
VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
HIDDEN_TAGS = frozenset(["script", "style", "template", "rt", "rp"])
HEADER_TAGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
VERBATIM_TAGS = frozenset(["pre", "textarea"])
ASCII_SPACES = " \t\n\f\r"
HELD = 4_000_000  # characters of page parts after which a task hands them on


class _Node:
    __slots__ = ("children",)

    def __init__(self):
        self.children: list = []


class _PageParser(HTMLParser):
    def __init__(self, autoclose: bool):
        super().__init__(convert_charrefs=True)
        self.autoclose = autoclose
        self.buf: list[str] = []
        self.pending: list[str] = []  # text since the last markup
        # open elements: (name, element_slot or -1, hidden flag, title node or None)
        self.stack: list[tuple] = []
        self.elems: list[list] = []  # [kind, start, end]
        self.hidden = 0
        self.title_root: _Node | None = None
        self.title_stack: list[_Node] = []
        self.title_done = False

    # text ---------------------------------------------------------------
    def handle_data(self, data):
        self.pending.append(data)

    def unknown_decl(self, data):
        self._flush()
        if data.startswith("CDATA["):
            self._text(data[6:])

    def handle_decl(self, decl):
        self._flush()

    def handle_pi(self, data):
        self._flush()

    def _flush(self):
        """One text node: what was read since the last markup; blank nodes shrink to one character."""
        data = "".join(self.pending)
        self.pending.clear()
        if data and not data.strip(ASCII_SPACES) and not any(e[0] in VERBATIM_TAGS for e in self.stack):
            data = "\n" if "\n" in data else " "
        if data:
            self._text(data)

    def _text(self, data):
        if self.title_stack:
            kids = self.title_stack[-1].children
            if kids and not isinstance(kids[-1], _Node) and kids[-1][0] == "text" and not self.hidden:
                kids[-1] = ("text", kids[-1][1] + data)
            else:
                kids.append(("hidden" if self.hidden else "text", data))
        if not self.hidden:
            self.buf.append(data)

    def handle_comment(self, data):
        self._flush()
        if self.title_stack:
            self.title_stack[-1].children.append(("comment", data))

    # tags ---------------------------------------------------------------
    def handle_starttag(self, tag, attrs):
        self._flush()
        if self.autoclose and tag == "p":
            self._pop_to("p")
        if tag in VOID_TAGS:
            if self.title_stack:
                self.title_stack[-1].children.append(_Node())
            return
        slot = -1
        if tag in HEADER_TAGS or tag == "p":
            slot = len(self.elems)
            self.elems.append(["h" if tag != "p" else "p", len(self.buf), -1])
        hidden = tag in HIDDEN_TAGS
        if hidden:
            self.hidden += 1
        node = None
        if self.title_stack:
            node = _Node()
            self.title_stack[-1].children.append(node)
            self.title_stack.append(node)
        elif tag == "title" and not self.title_done:
            node = self.title_root = _Node()
            self.title_stack.append(node)
        self.stack.append((tag, slot, hidden, node))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._flush()
        self._pop_to(tag)

    def _pop_to(self, tag):
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth][0] == tag:
                break
        else:
            return
        while len(self.stack) > depth:
            self._close(self.stack.pop())

    def _close(self, entry):
        _, slot, hidden, node = entry
        if slot >= 0:
            self.elems[slot][2] = len(self.buf)
        if hidden:
            self.hidden -= 1
        if node is not None and self.title_stack:
            self.title_stack.pop()
            if not self.title_stack:
                self.title_done = True

    def finish(self):
        self.close()
        self._flush()
        while self.stack:
            self._close(self.stack.pop())
        self.title_stack.clear()


def _title_string(node: _Node):
    if len(node.children) != 1:
        return None
    child = node.children[0]
    if isinstance(child, _Node):
        return _title_string(child)
    kind, text = child
    return text if kind in ("text", "comment", "hidden") else None


def extract_page(body: str | None, p_mode: str = "nested"):
    """H1-H4 for one page body: ``(title, headers, paras)``."""
    if body is None:
        return None, None, None
    text = unicodedata.normalize("NFKC", _html.unescape(body))
    parser = _PageParser(autoclose=(p_mode == "autoclose"))
    parser.feed(text)
    parser.finish()
    end = len(parser.buf)
    heads, paras = [], []
    for kind, start, stop in parser.elems:
        (heads if kind == "h" else paras).append("".join(parser.buf[start : stop if stop >= 0 else end]))
    title = ""
    if parser.title_root is not None:
        s = _title_string(parser.title_root)
        title = s if s is not None else ""
    return title, heads, paras


PAGE_PARTS = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("headers", T.ArrayType(T.StringType())),
        T.StructField("paras", T.ArrayType(T.StringType())),
    ]
)


def page_batches(batches: Iterator[pa.RecordBatch], schema: pa.Schema, p_mode: str, most: int = HELD) -> Iterator[pa.RecordBatch]:
    """Page parts of (key, body) batches, handed on after about ``most`` characters."""
    for batch in batches:
        lo = held = 0
        titles, heads, paras = [], [], []
        for i in range(len(batch)):
            body = batch.column(1)[i].as_py()
            t, h, p = extract_page(body, p_mode)
            titles.append(t)
            heads.append(h)
            paras.append(p)
            held += len(body or "") + sum(map(len, h or ())) + sum(map(len, p or ()))
            if held >= most or i + 1 == len(batch):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, i + 1 - lo), pa.array(titles, pa.string()), pa.array(heads, pa.list_(pa.string())),
                     pa.array(paras, pa.list_(pa.string()))],
                    schema=schema,
                )
                lo, held = i + 1, 0
                titles, heads, paras = [], [], []


def extract_html(df: DataFrame, key_col: str = "key", body_col: str = "body", p_mode: str = "nested") -> DataFrame:
    """One ``mapInArrow`` over ``(key, body)`` -> ``(key, title, headers, paras)``.

    Only the two needed columns cross into Python (column pruning); filters
    that drop pages must be applied *before* this step, Catalyst cannot push
    them through it.  What Python holds does not grow with the rows of a batch:
    the parts of a few megabytes of pages are handed on at a time.
    """
    if p_mode not in ("nested", "autoclose"):
        raise ValueError("p_mode must be 'nested' or 'autoclose'")
    key_field = df.schema[key_col]
    out_schema = T.StructType([T.StructField(key_col, key_field.dataType)] + PAGE_PARTS.fields)
    arrow_schema = pa.schema(
        [
            pa.field(key_col, _arrow_type(key_field.dataType)),
            pa.field("title", pa.string()),
            pa.field("headers", pa.list_(pa.string())),
            pa.field("paras", pa.list_(pa.string())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return page_batches(batches, arrow_schema, p_mode)

    return df.select(key_col, body_col).mapInArrow(run, out_schema)


def _arrow_type(dt: T.DataType) -> pa.DataType:
    if isinstance(dt, T.LongType):
        return pa.int64()
    if isinstance(dt, T.IntegerType):
        return pa.int32()
    if isinstance(dt, T.StringType):
        return pa.string()
    raise TypeError(f"unsupported key type {dt}")
