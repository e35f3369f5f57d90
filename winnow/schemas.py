"""Declared schemas of the relations that enter from files."""

from pyspark.sql import types as T

ITEM = T.StructType(
    [
        T.StructField("img_link", T.StringType()),
        T.StructField("img_attrs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("text_link", T.StringType()),
        T.StructField("text_desc", T.StringType()),
    ]
)

POST = T.StructType(
    [
        T.StructField("post_date", T.StringType()),
        T.StructField(
            "header",
            T.StructType(
                [
                    T.StructField("title_text", T.StringType()),
                    T.StructField("title_link", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "body",
            T.StructType(
                [
                    T.StructField("parsed", T.ArrayType(ITEM)),
                    T.StructField("raw_links", T.ArrayType(T.StringType())),
                    T.StructField("raw_images", T.ArrayType(T.StringType())),
                    T.StructField("raw_text", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "footer",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("tag", T.StringType()),
                        T.StructField("taglink", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

LISTING_PAGE = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("page_data", T.ArrayType(POST)),
        T.StructField("num_posts", T.IntegerType()),
        T.StructField("next_page", T.StringType()),
    ]
)

LABEL = T.StructType(
    [
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("ptid", T.StringType()),
                    T.StructField("text", T.StringType()),
                    T.StructField("post_title", T.StringType()),
                    T.StructField("languages", T.ArrayType(T.StringType())),
                    T.StructField("term_count", T.IntegerType()),
                    T.StructField("content_length", T.LongType()),
                    T.StructField("url", T.StringType()),
                ]
            ),
        )
    ]
)

SNAPSHOT_FIELDS = [
    "urlkey", "timestamp", "original", "mimetype", "statuscode", "digest", "length", "archive_url",
]
