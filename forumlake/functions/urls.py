from functools import reduce

from pyspark.sql import Column, functions as F

from forumlake.constants import URL_SCHEMES


def url_host(url: Column | str) -> Column:
    """Host by cutting text: schemes out, then up to the first '/', then up to the first '?'.

    User info, port, case and a leading 'www.' stay, which is why parse_url does not fit.
    """
    column = F.col(url) if isinstance(url, str) else url
    bare = reduce(lambda c, scheme: F.replace(c, F.lit(scheme), F.lit("")), URL_SCHEMES, column)
    for mark in ("/", "?"):
        bare = F.split_part(bare, F.lit(mark), F.lit(1))
    return bare
