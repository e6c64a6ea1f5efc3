"""Reads posts as JSON lines; writes a line for each post and for each term of the arguments that it holds as a word."""

import json
import sys

import regex

terms = {term.lower() for term in sys.argv[1:]}
words = regex.compile(r"[\p{L}\p{M}]+")
for line in sys.stdin:
    if not line.strip():
        continue
    post = json.loads(line)
    if "retweeted_status" in post:
        continue
    print("posts\t1")
    for term in sorted(terms.intersection(words.findall(post["text"].lower()))):
        print(f"{term}\t1")
