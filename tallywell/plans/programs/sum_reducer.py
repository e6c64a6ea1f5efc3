"""Reads key<tab>count lines sorted by key; writes each key with the sum of its counts. Lines without a whole number are left out."""

import sys

key, total = None, 0
for line in sys.stdin:
    name, _, count = line.rstrip("\n").partition("\t")
    try:
        value = int(count.partition("\t")[0])
    except ValueError:
        continue
    if name != key:
        if key is not None:
            print(f"{key}\t{total}")
        key, total = name, 0
    total += value
if key is not None:
    print(f"{key}\t{total}")
