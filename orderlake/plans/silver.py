"""Bronze documents -> flat silver tables.

Each ``build_<table>(docs)`` takes parsed documents (one row per order, the document
fields as columns, see ``orderlake.sources.ingest.parse_documents``) and returns the
table with the source's camelCase names; ``silver_table`` gives the stored form
(snake_case names).  Row rules are the ones of the source pipeline: inner explodes lose
orders without elements, outer explodes keep one null row, sibling arrays multiply.

Every builder is narrow: explodes and projections run in one stage per input
partition; only ``items`` shuffles (its full-row dedupe, pre-aggregated map-side), and where documents are
marked with ``MAY_REPEAT`` only the rows that may equal others do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.digest import row_digest
from orderlake.functions.naming import snake_case_columns
from orderlake.operators.flatten import drop_all_null, explode_map
from orderlake.operators.metrics import materialize


def _cols(prefix: str, names: list[str]) -> list:
    return [F.col(f"{prefix}.`{n}`").alias(n) for n in names]


# Column lists of the silver tables, in the source pipeline's order.
ORDER_COLUMNS = [
    "orderId", "sellerOrderId", "origin", "salesChannel", "status", "workflowIsInError",
    "statusDescription", "value", "creationDate", "lastChange", "authorizedDate",
    "isCompleted", "followUpEmail", "orderGroup"]

CLIENT_PROFILE_FIELDS = [
    "id", "email", "firstName", "lastName", "documentType", "document", "phone",
    "corporateName", "tradeName", "corporateDocument", "stateInscription",
    "corporatePhone", "isCorporate", "userProfileId", "userProfileVersion",
    "customerClass"]

RATE_FIELDS = ["description", "featured", "id", "name", "matchedParameters",
               "additionalInfo"]

MARKETING_FIELDS = ["id", "utmSource", "utmPartner", "utmMedium", "utmCampaign", "coupon",
                    "utmiCampaign", "utmipage", "utmiPart"]

ITEM_PLAIN_FIELDS = [
    "uniqueId", "productId", "ean", "lockId", "seller", "refId", "listPrice",
    "manualPrice", "priceTags", "imageUrl", "detailUrl", "params", "sellerSku",
    "priceValidUntil", "commission", "tax", "preSaleDate", "measurementUnit",
    "unitMultiplier", "sellingPrice", "isGift", "shippingPrice", "rewardValue",
    "freightCommission", "taxCode", "parentItemIndex", "parentAssemblyBinding",
    "callCenterOperator", "serialNumbers", "assemblies", "costPrice"]

ADDITIONAL_INFO_FIELDS = ["brandName", "brandId", "categoriesIds", "productClusterId",
                          "commercialConditionId", "offeringInfo", "offeringType",
                          "offeringTypeId"]

DIMENSION_FIELDS = ["cubicweight", "height", "length", "weight", "width"]

LOGISTICS_FIELDS = [
    "itemIndex", "selectedSla", "lockTTL", "price", "listPrice", "sellingPrice",
    "deliveryWindow", "deliveryCompany", "shippingEstimate", "shippingEstimateDate"]

LOGISTICS_TAIL_FIELDS = ["deliveryChannel", "polygonName", "pickupPointId", "transitTime"]

ADDRESS_FIELDS = ["addressType", "receiverName", "postalCode", "city", "state", "country",
                  "street", "number", "neighborhood", "complement", "reference",
                  "geoCoordinates"]

DELIVERY_ID_FIELDS = ["courierId", "courierName", "dockId", "quantity", "warehouseId",
                      "accountCarrierName"]

PAYMENT_FIELDS = [
    "id", "paymentSystem", "paymentSystemName", "value", "installments",
    "referenceValue", "cardHolder", "cardNumber", "firstDigits", "lastDigits", "cvv2",
    "expireMonth", "expireYear", "url", "giftCardId", "giftCardName", "giftCardCaption",
    "redemptionCode", "group", "tid", "dueDate", "giftCardProvider",
    "giftCardAsDiscount", "koinUrl", "accountId", "parentAccountId",
    "bankIssuedInvoiceIdentificationNumber",
    "bankIssuedInvoiceIdentificationNumberFormatted", "bankIssuedInvoiceBarCodeNumber",
    "bankIssuedInvoiceBarCodeType", "billingAddress", "paymentOrigin"]

STORE_FIELDS = ["countryCode", "currencyCode", "currencyLocale", "currencySymbol",
                "timeZone"]
CURRENCY_FORMAT_FIELDS = ["CurrencyDecimalDigits", "CurrencyDecimalSeparator",
                          "CurrencyGroupSeparator", "CurrencyGroupSize",
                          "StartsWithCurrencySymbol"]

SELLER_FIELDS = ["id", "name", "logo", "fulfillmentEndpoint"]

METADATA_ITEM_FIELDS = ["Id", "Seller", "Name", "SkuName", "ProductId", "RefId", "Ean",
                        "ImageUrl", "DetailUrl"]

CANCELLATION_FIELDS = ["RequestedByUser", "RequestedBySystem",
                       "RequestedBySellerNotification", "RequestedByPaymentNotification",
                       "Reason", "CancellationDate"]


# ---------------------------------------------------------------------------
# Builders
# ---------------------------------------------------------------------------

def build_orders(docs: DataFrame) -> DataFrame:
    """One row per document, the scalar order fields."""
    return docs.select(*ORDER_COLUMNS)


def build_totals(docs: DataFrame) -> DataFrame:
    """B1: one row per totals entry; orders without totals give no row."""
    return (docs.select("orderId", F.explode("totals").alias("t"))
            .select("orderId", *_cols("t", ["id", "name", "value"])))


#: Columns beside documents, and beside rows of items: whether a document's item rows may equal others (of it or
#: of another document), and the digest of such a row.
MAY_REPEAT, DIGEST = "may_repeat_rows", "row_digest"


def items_may_repeat() -> Column:
    """Whether item rows of one document may equal each other.  They cannot where every item has a ``uniqueId`` of
    its own and no array or map of an item holds an entry twice, as all of these are columns of the rows."""
    some = lambda condition: F.coalesce(condition, F.lit(False))
    twice = lambda array: some(
        (F.size(array) > 1) & (F.size(F.array_distinct(array)) < F.size(array)))
    # a null entry gives the same row as an entry of nulls
    cut = lambda array, *names: F.transform(array, lambda e: F.struct(*(e[n].alias(n) for n in names)))

    def item(it: Column) -> Column:
        offers = it["attachmentOfferings"]
        return (twice(it["priceTags"]) | twice(it["params"]) | twice(it["assemblies"])
                | twice(cut(it["offerings"], "type", "id", "name", "price"))
                | twice(cut(offers, "name", "required"))
                | twice(F.map_keys(it["itemAttachment"]["content"]))
                | twice(cut(it["additionalInfo"]["categories"], "id", "name"))
                | twice(cut(it["priceDefinition"]["sellingPrices"], "value", "quantity"))
                | some(F.exists(offers, lambda o: twice(F.map_keys(o["schema"])) | some(
                    F.exists(F.map_values(o["schema"]), lambda v: twice(v["Domain"]))))))

    return twice(F.col("items.uniqueId")) | some(F.exists("items", item))


def repeats_marked(docs: DataFrame) -> DataFrame:
    """Stored documents with ``MAY_REPEAT``, which holds ``items_may_repeat`` so far, also true where an order id
    comes more than once or is null."""
    counts = docs.where(F.col("orderId").isNotNull()).groupBy("orderId").count()
    again = materialize(counts.where("count > 1").select(F.col("orderId").alias("__again")), "repeated")
    marked = F.col(MAY_REPEAT) | F.col("orderId").isNull()
    if again.isEmpty():  # the usual case
        return docs.withColumn(MAY_REPEAT, marked)
    return docs.join(again, F.col("orderId") == F.col("__again"), "left") \
        .withColumn(MAY_REPEAT, marked | F.col("__again").isNotNull()).drop("__again")


def build_items(docs: DataFrame) -> DataFrame:
    """B2: one row per item x every combination of its inner arrays and maps, deduplicated.

    Generators: items (inner); priceTags, params, offerings, attachmentOfferings,
    assemblies (outer); itemAttachment.content and the attachment-offering schema map
    (outer, key/value); categories, sellingPrices, Domain (outer).  ``attachments`` and
    ``components`` are not expanded: exploding them would only repeat identical rows,
    which the final dedupe removes again, so they are left out of the plan.

    Of stored documents marked with ``MAY_REPEAT`` (``repeats_marked``) the rows that cannot equal others are
    not compared with any.
    """
    if MAY_REPEAT not in docs.columns:
        return _item_rows(docs).dropDuplicates()
    sure, rest = docs.where(~F.col(MAY_REPEAT)), docs.where(MAY_REPEAT)
    if rest.isEmpty():
        return _item_rows(sure)
    return _item_rows(sure).unionByName(_item_rows(rest).dropDuplicates())


def digested_items(docs: DataFrame) -> DataFrame:
    """Item rows, snake-cased and not deduplicated, of documents marked with ``MAY_REPEAT``; ``DIGEST`` tells the
    marked ones apart and is null for the others."""
    rows = snake_case_columns(_item_rows(docs, MAY_REPEAT))
    return rows.withColumn(DIGEST, F.when(F.col(MAY_REPEAT), row_digest(rows.schema, (MAY_REPEAT,))))


def _item_rows(docs: DataFrame, *keep: str) -> DataFrame:
    it = docs.select("orderId", *keep, F.explode("items").alias("it"))
    it = (it
          .withColumn("priceTags", F.explode_outer("it.priceTags"))
          .withColumn("params", F.explode_outer("it.params"))
          .withColumn("offering", F.explode_outer("it.offerings"))
          .withColumn("attOffering", F.explode_outer("it.attachmentOfferings"))
          .withColumn("assemblies", F.explode_outer("it.assemblies"))
          .withColumn("content", F.col("it.itemAttachment.content"))
          .transform(lambda d: explode_map(d, "content", "content_key", "content_value"))
          .withColumn("schema", F.col("attOffering.schema"))
          .transform(lambda d: explode_map(d, "schema", "schema_key", "schema_value"))
          .withColumn("category", F.explode_outer("it.additionalInfo.categories"))
          .withColumn("sellingPriceEntry",
                      F.explode_outer("it.priceDefinition.sellingPrices"))
          .withColumn("Domain", F.explode_outer("schema_value.Domain")))
    exploded = {"priceTags", "params", "assemblies"}
    plain = [F.col(n) if n in exploded else F.col(f"it.{n}").alias(n)
             for n in ITEM_PLAIN_FIELDS]
    out = it.select(
        "orderId", *keep, *plain,
        F.col("it.name").alias("items_name"),
        F.col("it.id").alias("items_id"),
        F.col("it.price").alias("items_price"),
        F.col("it.quantity").alias("items_quantity"),
        F.col("it.itemAttachment.name").alias("itemAttachment_name"),
        F.col("offering.type").alias("type"),
        F.col("offering.name").alias("offerings_name"),
        F.col("offering.id").alias("offerings_id"),
        F.col("offering.price").alias("offerings_price"),
        F.col("attOffering.required").alias("required"),
        F.col("attOffering.name").alias("attachmentOfferings_name"),
        *_cols("it.additionalInfo", ADDITIONAL_INFO_FIELDS),
        *_cols("it.priceDefinition", ["calculatedSellingPrice", "total", "reason"]),
        "content_key", "content_value", "schema_key",
        F.col("category.name").alias("categories_name"),
        F.col("category.id").alias("categories_id"),
        *_cols("it.additionalInfo.dimension", DIMENSION_FIELDS),
        F.col("sellingPriceEntry.value").alias("value"),
        F.col("sellingPriceEntry.quantity").alias("sellingPrices_quantity"),
        F.col("schema_value.MaximumNumberOfCharacters").alias("MaximumNumberOfCharacters"),
        "Domain")
    # as grouping does: 0.0 for -0.0, so that rows are the same with and without a comparison
    floats = [f.name for f in out.schema.fields if f.dataType.typeName() == "float"]
    return out.withColumns({n: F.when(F.col(n) == 0, F.lit(0.0).cast("float")).otherwise(F.col(n)) for n in floats})


def build_marketplace_items(docs: DataFrame) -> DataFrame:
    """One row per marketplace item, one null row for none."""
    return docs.select("orderId", F.explode_outer("marketplaceItems").alias("marketplaceItems"))


def build_client_profile(docs: DataFrame) -> DataFrame:
    """One row per document, the 16 profile fields."""
    return docs.select("orderId", *_cols("clientProfileData", CLIENT_PROFILE_FIELDS))


def build_rates_and_benefits(docs: DataFrame) -> DataFrame:
    """One row per rate identifier, all-null rows dropped; no order id (as stored)."""
    rates = docs.select(
        F.explode_outer("ratesAndBenefitsData.rateAndBenefitsIdentifiers").alias("r"))
    return drop_all_null(rates.select(*_cols("r", RATE_FIELDS)))


def build_marketing(docs: DataFrame) -> DataFrame:
    """Marketing fields, one row per tag (one null row for none)."""
    return docs.select("orderId", *_cols("marketingData", MARKETING_FIELDS),
                       F.explode_outer("marketingData.marketingTags").alias("marketingTag"))


def build_shipping(docs: DataFrame) -> DataFrame:
    """Logistics entries x slas x shipsTo x deliveryIds x deliveryChannels x kit items.

    ``slas`` multiplies rows without adding columns; those copies are kept here (the
    order summary deduplicates).
    """
    s = docs.select("orderId", F.col("shippingData.trackingHints").alias("trackingHints"),
                    F.col("shippingData.address").alias("address"),
                    F.explode_outer("shippingData.logisticsInfo").alias("li"))
    s = (s.withColumn("sla", F.explode_outer("li.slas"))
         .withColumn("shipsTo", F.explode_outer("li.shipsTo"))
         .withColumn("deliveryId", F.explode_outer("li.deliveryIds"))
         .withColumn("deliveryChannelEntry", F.explode_outer("li.deliveryChannels"))
         .withColumn("kitItemDetails", F.explode_outer("deliveryId.kitItemDetails")))
    return s.select(
        "orderId", "trackingHints", *_cols("li", LOGISTICS_FIELDS), "shipsTo",
        *_cols("li", LOGISTICS_TAIL_FIELDS),
        F.col("li.deliveryChannel").alias("logistics_deliveryChannel"),
        *_cols("address", ADDRESS_FIELDS),
        *_cols("deliveryId", DELIVERY_ID_FIELDS), "kitItemDetails",
        F.col("deliveryChannelEntry.stockBalance").alias("stockBalance"))


def build_store_preferences(docs: DataFrame) -> DataFrame:
    """Store preferences with the currency format expanded."""
    return docs.select("orderId", *_cols("storePreferencesData", STORE_FIELDS),
                       *_cols("storePreferencesData.currencyFormatInfo",
                              CURRENCY_FORMAT_FIELDS))


def build_payment(docs: DataFrame) -> DataFrame:
    """Gift cards x transactions x payments x connector-response entries (all outer)."""
    p = (docs.select("orderId",
                     F.explode_outer("paymentData.giftCards").alias("giftCard"),
                     F.col("paymentData.transactions").alias("transactions"))
         .withColumn("tx", F.explode_outer("transactions"))
         .withColumn("pay", F.explode_outer("tx.payments"))
         .withColumn("connectorResponses", F.col("pay.connectorResponses"))
         .transform(lambda d: explode_map(d, "connectorResponses",
                                          "connector_key", "connector_value")))
    return p.select("orderId", *_cols("tx", ["isActive", "transactionId", "merchantName"]),
                    *_cols("pay", PAYMENT_FIELDS), "connector_key", "connector_value")


def build_package_attachment(docs: DataFrame) -> DataFrame:
    """One row per package, one null row for none."""
    return docs.select("orderId",
                       F.explode_outer("packageAttachment.packages").alias("packages"))


def build_sellers(docs: DataFrame) -> DataFrame:
    """One row per seller; orders without sellers give no row."""
    return (docs.select("orderId", F.explode("sellers").alias("s"))
            .select("orderId", *_cols("s", SELLER_FIELDS)))


def build_item_metadata(docs: DataFrame) -> DataFrame:
    """Metadata items x assembly options x takeback domain x warranty domain."""
    m = (docs.select("orderId", F.explode_outer("itemMetadata.Items").alias("m"))
         .withColumn("option", F.explode_outer("m.AssemblyOptions"))
         .withColumn("takeback_domain",
                     F.explode_outer("option.InputValues.takeback.Domain"))
         .withColumn("garantia_estendida_domain",
                     F.explode_outer("option.InputValues.`garantia-estendida`.Domain")))
    return m.select("orderId", *_cols("m", METADATA_ITEM_FIELDS),
                    F.col("option.Id").alias("Assemble_id"),
                    F.col("option.Name").alias("Assembly_name"),
                    F.col("option.Required").alias("Required"),
                    F.col("option.Composition").alias("Composition"),
                    "takeback_domain", "garantia_estendida_domain")


def build_client_preferences(docs: DataFrame) -> DataFrame:
    """One row per document."""
    return docs.select("orderId", *_cols("clientPreferencesData",
                                         ["locale", "optinNewsLetter"]))


def build_cancellation(docs: DataFrame) -> DataFrame:
    """One row per document (nulls when not cancelled), names already snake_case."""
    return snake_case_columns(
        docs.select("orderId", *_cols("cancellationData", CANCELLATION_FIELDS)))


BUILDERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "orders": build_orders,
    "totals": build_totals,
    "items": build_items,
    "marketplace_items": build_marketplace_items,
    "client_profile": build_client_profile,
    "rates_and_benefits": build_rates_and_benefits,
    "marketing": build_marketing,
    "shipping_data": build_shipping,
    "store_preferences": build_store_preferences,
    "payment": build_payment,
    "package_attachment": build_package_attachment,
    "sellers": build_sellers,
    "item_metadata": build_item_metadata,
    "client_preferences": build_client_preferences,
    "cancellation": build_cancellation,
}


# Document fields each builder reads (top-level fields, nested subtrees it never reads).
# Parsing only these is what keeps the JSON parse proportional to the table built.
READS: dict[str, tuple[list[str], list[str]]] = {
    "orders": (ORDER_COLUMNS, []),
    "totals": (["orderId", "totals"], []),
    "items": (["orderId", "items"], ["items.attachments", "items.components",
                                     "items.bundleItems"]),
    "marketplace_items": (["orderId", "marketplaceItems"], []),
    "client_profile": (["orderId", "clientProfileData"], []),
    "rates_and_benefits": (["ratesAndBenefitsData"], []),
    "marketing": (["orderId", "marketingData"], []),
    "shipping_data": (["orderId", "shippingData"],
                      ["shippingData.selectedAddresses",
                       "shippingData.logisticsInfo.slas.pickupStoreInfo",
                       "shippingData.logisticsInfo.pickupStoreInfo"]),
    "store_preferences": (["orderId", "storePreferencesData"], []),
    "payment": (["orderId", "paymentData"], []),
    "package_attachment": (["orderId", "packageAttachment"], []),
    "sellers": (["orderId", "sellers"], []),
    "item_metadata": (["orderId", "itemMetadata"], []),
    "client_preferences": (["orderId", "clientPreferencesData"], []),
    "cancellation": (["orderId", "cancellationData"], []),
}


# Everything any silver table reads: the one parse of the bronze text keeps only this.
DOCUMENT_FIELDS = sorted({f for fields, _ in READS.values() for f in fields})
DOCUMENT_SKIP = sorted({p for _, skip in READS.values() for p in skip})


def document_reads(names) -> tuple[list[str], list[str]]:
    """Document fields that some of the tables ``names`` read, and nested subtrees that none reads."""
    fields = {f for n in names for f in READS[n][0]}
    return sorted(fields), sorted({p for n in names for p in READS[n][1]})


def silver_table(docs: DataFrame, name: str) -> DataFrame:
    """A silver table as stored: built, then every column name in snake_case."""
    return snake_case_columns(BUILDERS[name](docs))


def silver_from_bronze(bronze: DataFrame, name: str) -> DataFrame:
    """Parse only the document fields ``name`` needs, then build and snake-case it."""
    from orderlake.sources.ingest import parse_documents
    fields, skip = READS[name]
    return silver_table(parse_documents(bronze, fields=fields, skip=skip), name)
