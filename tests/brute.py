"""Plain-Python versions of the scores, written from their definitions."""

import math
import re
from collections import Counter, defaultdict

from rankloom.functions.text import STOP_WORDS

WORD = re.compile(r"[#@\w](?:['\-]?\w){2,24}")


def tokens(text):
    return [t for t in WORD.findall(text.lower()) if t not in set(STOP_WORDS)]


class Corpus:
    def __init__(self, docs):
        self.n_docs = len(docs)
        self.tf = {doc: Counter(tokens(text)) for doc, text in docs.items()}
        self.df = Counter(term for counts in self.tf.values() for term in counts)
        self.length = {doc: sum(c.values()) for doc, c in self.tf.items() if c}
        self.average = sum(self.length.values()) / self.n_docs

    def scores(self, query, contribution):
        found = defaultdict(float)
        for term in tokens(query):
            for doc, counts in self.tf.items():
                if term in counts:
                    found[doc] += contribution(term, doc, counts[term])
        return dict(found)

    def idf(self, term, n=None):
        return math.log10((n or self.n_docs) / self.df[term])

    def tfidf(self, query):
        return self.scores(query, lambda t, d, tf: tf * self.idf(t))

    def bm25(self, query, k1=1.2, b=0.75):
        def one(term, doc, tf):
            length = 1 - b + b * self.length[doc] / self.average
            return self.idf(term) * tf * (k1 + 1) / (tf + k1 * length)

        return self.scores(query, one)

    def word_count(self, query):
        return self.scores(query, lambda t, d, tf: 1)

    def tf_count(self, query):
        return self.scores(query, lambda t, d, tf: tf)

    def distinct(self, query):
        return self.scores(" ".join(set(tokens(query))), lambda t, d, tf: 1)

    def vector(self, counts):
        n = len(self.df)
        return {t: c * self.idf(t, n) for t, c in counts.items() if t in self.df}

    @staticmethod
    def cosine(left, right):
        dot = sum(w * right.get(t, 0) for t, w in left.items())
        norms = math.hypot(*left.values()) * math.hypot(*right.values())
        return dot / norms if norms else 0.0

    def per_term(self, query):
        vector = self.vector(Counter(tokens(query)))
        n = len(self.df)
        return self.scores(
            query, lambda t, d, tf: self.cosine(vector, {t: tf * self.idf(t, n)})
        )

    def full(self, query):
        vector = self.vector(Counter(tokens(query)))
        return {
            doc: self.cosine(vector, self.vector(self.tf[doc])) for doc in self.word_count(query)
        }


def ranked(scores, k):
    return sorted(scores.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k]
