"""The plain distance table, cell by cell, to check against."""


def osa(a: str, b: str) -> int:
    d = {(i, 0): i for i in range(len(a) + 1)}
    d.update({(0, j): j for j in range(len(b) + 1)})
    for j in range(1, len(b) + 1):
        for i in range(1, len(a) + 1):
            options = [
                d[i - 1, j] + 1,
                d[i, j - 1] + 1,
                d[i - 1, j - 1] + (a[i - 1] != b[j - 1]),
            ]
            if i > 1 and j > 1 and a[i - 2 : i] == b[j - 2 : j][::-1]:
                options.append(d[i - 2, j - 2] + 1)
            d[i, j] = min(options)
    return d[len(a), len(b)]
