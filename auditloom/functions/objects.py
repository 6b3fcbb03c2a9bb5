"""Object names, URIs, generations and thumbnails."""

from pyspark.sql import functions as F

from auditloom import fixed

# Unicode white space, with the ASCII separators.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(col):
    """Trim Unicode white space on both ends (plain `trim` only knows the blank)."""
    return F.btrim(col, F.lit(WHITE_SPACE))


def is_blank(col):
    return strip(col) == ""


def parse_generation(col):
    """Text to a generation in 1 .. 2^63-1, else NULL.

    Only ASCII digits count; leading zeros and outer white space are allowed.
    """
    text = strip(col)
    number = F.when(text.rlike(r"\A[0-9]+\z"), text.try_cast("bigint"))
    return F.when(number > 0, number)


def valid_bucket(col):
    return F.coalesce(
        col.rlike(rf"(?U)\A[\p{{L}}\p{{N}}]([^\s\x1c-\x1f/]*[\p{{L}}\p{{N}}])?\z"), F.lit(False)
    )


def valid_name(col):
    return F.coalesce(~is_blank(col), F.lit(False))


def is_supported_image(col):
    return F.lower(col).rlike(r"\.(" + "|".join(fixed.IMAGE_EXTENSIONS) + r")\z")


def object_uri(bucket, name):
    return F.concat(F.lit(fixed.URI_SCHEME), bucket, F.lit("/"), name)


def names_object(col):
    """Whether a URI has both a bucket and an object."""
    return col.rlike(r"(?s)\A(?:" + fixed.URI_SCHEME + r")?+[^/]+/.")


def split_uri(col, strict=False):
    """(bucket, object) columns of a URI.

    Lenient: the scheme is optional and a bare bucket has the object ''.
    Strict: NULLs unless the scheme, a bucket and a non-empty object are there.
    """
    body = F.when(
        col.startswith(fixed.URI_SCHEME), F.substr(col, F.lit(len(fixed.URI_SCHEME) + 1))
    ).otherwise(col)
    slash = F.instr(body, "/")
    bucket = F.when(slash > 0, F.substr(body, F.lit(1), slash - 1)).otherwise(body)
    name = F.when(slash > 0, F.substr(body, slash + 1)).otherwise(F.substr(body, F.lit(1), F.lit(0)))
    if not strict:
        return bucket, name
    good = col.startswith(fixed.URI_SCHEME) & (bucket != "") & (name != "")
    return F.when(good, bucket), F.when(good, name)


def stem(path):
    """A path without its last extension; leading dots never start one."""
    return F.regexp_replace(
        path, r"(?s)\A((?:.*/)?\.*[^./][^/]*)\.[^./]*\z", "$1"
    )


def image_id(uri):
    """Base name of a URI without its last extension."""
    return stem(F.substring_index(uri, "/", -1))


def thumb_location(bucket, image, stored_uri):
    """(bucket, object) of a thumbnail for the refresh job.

    The stored URI wins where it has both parts; otherwise the name is derived
    from the bucket and the image id.
    """
    stored_bucket, stored_name = split_uri(stored_uri)
    usable = F.coalesce((stored_bucket != "") & (stored_name != ""), F.lit(False))
    return (
        F.when(usable, stored_bucket).otherwise(
            F.concat(bucket, F.lit(fixed.THUMB_BUCKET_SUFFIX))
        ),
        F.when(usable, stored_name).otherwise(
            F.concat(F.lit(fixed.THUMB_FOLDER + "/"), image, F.lit(fixed.THUMB_ENDING))
        ),
    )


def written_thumb_uri(bucket, name):
    """Where the worker puts a new thumbnail: it keeps the whole object path."""
    return object_uri(
        F.concat(bucket, F.lit(fixed.THUMB_BUCKET_SUFFIX)),
        F.concat(F.lit(fixed.THUMB_FOLDER + "/"), stem(name), F.lit(fixed.THUMB_ENDING)),
    )


def job_id(uri, version):
    return F.sha2(F.concat(uri, F.lit(":"), version), 256)


def thumb_size(width, height, box=fixed.THUMB_BOX):
    """(width, height) after fitting into a square box.

    Smaller images keep their size. The longer side becomes the box; the other
    is rounded up or down to whichever stays closer to the aspect ratio, and is
    at least 1.
    """
    ratio = width / height
    side = F.lit(float(box))
    small = (width <= box) & (height <= box)

    def nearest(exact, distance):
        low, high = F.floor(exact), F.ceil(exact)
        return F.greatest(
            F.when(distance(low) <= distance(high), low).otherwise(high), F.lit(1)
        )

    narrow = nearest(side * ratio, lambda n: F.abs(ratio - n / side))
    flat = nearest(
        side / ratio,
        lambda n: F.when(n == 0, F.lit(0.0)).otherwise(F.abs(ratio - F.try_divide(side, n))),
    )
    tall = ratio <= 1
    return (
        F.when(small, width).when(tall, narrow).otherwise(F.lit(box)).cast("bigint"),
        F.when(small, height).when(tall, F.lit(box)).otherwise(flat).cast("bigint"),
    )
