import random

import pytest

from rankfold.llm import html_text as H


@pytest.fixture(scope="module")
def tree():
    return H.grow(*H.labelled_rows())


def written(page, rng, name):
    """HTML of a labelled page, every element with a made-up class name; and the text to expect."""
    out, want = [], []
    for path, words, linked, label in page:
        text = [f"{rng.choice('bcdfghk')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{i}" for i in range(words)]
        tags = path.split()
        inner = (f"<a href='/{rng.randrange(99)}'>{' '.join(text[:linked])}</a> " if linked else "") + " ".join(text[linked:])
        start = "".join(f"<{t} class='{name()}' id='{name()}'>" for t in tags)
        out.append(start + inner + "".join(f"</{t}>" for t in reversed(tags)))
        if label:
            want.append(" ".join(text))
    return "<html><body>" + "\n".join(out) + "</body></html>", "\n".join(want)


@pytest.mark.parametrize("seed", [101, 102])
def test_pages_whose_names_and_tags_tell_nothing(tree, seed):
    rng, right = random.Random(seed), 0
    pages = H.plain_pages(seed, 150)
    scrambled = lambda: "".join(rng.choice("qxzjvw") for _ in range(6))
    for page in pages:
        html, want = written(page, rng, scrambled)
        assert all(not f & (H.IN_BOILERPLATE | H.HINTED | H.IN_ARTICLE) for *_, f in H.blocks(html))
        right += H.main_text(tree, html) == want
    assert right >= 0.95 * len(pages)


def test_flags_alone_would_keep_what_the_tree_drops(tree):
    by_flags = kept = dropped = 0
    for page in H.plain_pages(7, 100):
        html, _ = written(page, random.Random(1), lambda: "zzz")
        found = H.blocks(html)
        verdicts = [H.classify(tree, r) for r in H.features(found)]
        flags = [not f & (H.IN_BOILERPLATE | H.HINTED) for *_, f in found]
        by_flags += sum(flags)
        kept, dropped = kept + sum(verdicts), dropped + verdicts.count(0)
    assert by_flags == kept + dropped and dropped > 0.3 * by_flags


def test_neighbours_decide(tree):
    def used(t):
        return set() if isinstance(t, int) else {t[0]} | used(t[2]) | used(t[3])

    assert used(tree) & {0, 1, 4, 5}  # word counts and densities of the blocks before and behind
    short, long, menu = ("few words here", 3, 0, 0), ("w " * 60, 60, 0, 0), ("Home", 1, 1, 0)
    inside, outside = [long, short, long], [menu, short, menu]
    assert H.classify(tree, H.features(inside)[1]) == 1 and H.classify(tree, H.features(outside)[1]) == 0


@pytest.mark.parametrize("seed", [11, 12])
def test_pages_with_an_article_of_their_own(tree, seed):
    rng = random.Random(seed)
    for page in H.tagged_pages(seed, 100):
        rows, labels = [], []
        found = []
        for path, words, links, label in page:
            flags, hint = 0, False
            for step in path.split():
                tag, _, name = step.partition(".")
                flags = H.enter(flags, tag)
                hint = (hint and tag not in ("article", "main")) or H.hinted(flags, tag, name)
            found.append(("", words, links, flags | (H.HINTED if hint else 0)))
            labels.append(label)
        rows = H.features(found)
        assert [H.classify(tree, r) for r in rows] == labels
    assert rng
