"""Bronze order documents made from the flat test tables (orders, lineitem, customer).

Each order becomes one JSON text in a column ``orderDetails``, the shape the bronze
layer holds.  The rules are deterministic functions of the flat columns, so an
independent SQL query over the same flat tables can compute every silver and gold
answer without going through JSON (see ``orderlake.plans.oracle``).

Scale: line items are grouped once per order (one shuffle of ``lineitem`` on the order
key, which is also the join key of ``orders``, so the join reuses that partitioning);
customers join on their key with a sort-merge join or, when small, a broadcast picked by
AQE from measured sizes.  A document is one row by definition, so an order's items are
gathered into that row; nothing is gathered per status, channel or customer.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.functions.scalars import evaluated_once


def _null_str() -> Column:
    return F.lit(None).cast("string")


def _struct(**fields: Column) -> Column:
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def _str(c: Column) -> Column:
    return c.cast("string")


def _cents(amount: Column) -> Column:
    """Money in integer cents: round(amount * 100)."""
    return F.round(amount * F.lit(100)).cast("bigint")


def _pct(rate: Column) -> Column:
    """A fraction with two decimals as an integer percent."""
    return F.round(rate * F.lit(100)).cast("int")


def load_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three flat tables documents are made from, columns pruned at the scan."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return {
        "orders": read("orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
            "o_orderpriority"),
        "lineitem": read("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
            "l_shipdate"),
        "customer": read("customer").select(
            "c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
    }


# ---------------------------------------------------------------------------
# JSON text, the same as ``to_json`` of structs
# ---------------------------------------------------------------------------

class _Text:
    """Text in pieces; constants next to each other are joined beforehand, so that one flat ``concat`` makes it."""

    def __init__(self, *pieces: str | Column | _Text):
        self.pieces: list[str | Column] = []
        for piece in pieces:
            for part in piece.pieces if isinstance(piece, _Text) else [piece]:
                if isinstance(part, str) and self.pieces and isinstance(self.pieces[-1], str):
                    self.pieces[-1] += part
                elif not (isinstance(part, str) and not part):
                    self.pieces.append(part)

    @property
    def column(self) -> Column:
        columns = [F.lit(p) if isinstance(p, str) else p for p in self.pieces]
        return columns[0] if len(columns) == 1 else F.concat(*columns)


class _Maybe:
    """JSON text that may be null; a null member is left out of its object."""

    def __init__(self, text: Column | _Text):
        self.text = text

    def member(self, before: str, after: str) -> list[str | Column]:
        return [F.coalesce(_text(before, self.text, after), F.lit(""))]


class _Lines(_Maybe):
    """The long text of an order's lines between brackets, put into the document without a copy of its own."""

    def __init__(self, before: str, texts: Column, after: str):
        super().__init__(_Text(before, texts, after))
        self.pieces = before, texts, after

    def member(self, before: str, after: str) -> list[str | Column]:
        opened, texts, closed = self.pieces
        given = lambda text: F.when(texts.isNull(), F.lit("")).otherwise(F.lit(text))
        return [given(before + opened), F.coalesce(texts, F.lit("")), given(closed + after)]


def _text(*pieces: str | Column | _Text) -> Column:
    return _Text(*pieces).column


def _number(value: Column) -> _Maybe:
    return _Maybe(_str(value))


def _string(*pieces: str | Column) -> _Maybe:
    """A JSON string of constants and numbers, which need no escapes; null if a piece is."""
    return _Maybe(_Text('"', *pieces, '"'))


def _present(member: _Maybe) -> Column | _Text:
    """The text of a member whose pieces are known not to be null."""
    return member.text


def _or_null(member: _Maybe) -> Column:
    return F.coalesce(_text(member.text), F.lit("null"))


def _unbracketed(text: Column) -> Column:
    """The JSON text of the one element of an array, which must not be an array itself; ``text`` is used once, since
    within a condition it would be evaluated each time that it is."""
    return F.trim(text, F.lit("[]"))


def _quoted(value: Column, prefix: str = "") -> Column:
    """A JSON string of ``prefix``, which needs no escapes, and any text; null for null."""
    # The lambda also keeps the projection out of whole-stage code, where all texts would be one method, too
    # long to be compiled to machine code.
    escaped = F.to_json(F.transform(F.array(value), lambda v: F.concat(F.lit(prefix), v)))
    return F.when(value.rlike(r"[^ !#-\[\]-~]"), _unbracketed(escaped)).otherwise(_text(f'"{prefix}', value, '"'))


def _written(value: Column) -> _Maybe:
    """The JSON text of a date or number, as ``to_json`` writes it."""
    return _Maybe(F.when(value.isNotNull(), _unbracketed(F.to_json(F.array(value)))))


def _object(**members: str | Column | _Text | _Maybe) -> _Text:
    """A JSON object text: members with a text always (constants, columns) or ``_Maybe`` one."""
    named = list(members.items())
    sure = next((i for i, (_, v) in enumerate(named) if not isinstance(v, _Maybe)), None)
    pieces: list[str | Column | _Text] = []
    for i, (name, value) in enumerate(named):
        before, after = ("", ",") if sure is not None and i < sure else ("," if sure != i else "", "")
        if isinstance(value, _Maybe):
            pieces += value.member(f'{before}"{name}":', after)
        else:
            pieces += [f'{before}"{name}":', value]
    if sure is None:  # every member has a comma before it
        return _Text("{", F.substring(_text(*pieces), 2, 1 << 30), "}")
    return _Text("{", *pieces, "}")


# ---------------------------------------------------------------------------
# Line item -> items[i], logisticsInfo[i], itemMetadata.Items[i]
# ---------------------------------------------------------------------------

def _line() -> Column:
    """What documents take from a line item; ``whole`` tells that no number and no date of it is null."""
    unit = F.expr("cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)")
    selling = F.expr(
        "((cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint))"
        " * (100 - cast(round(l_discount * 100) as int))) div 100")
    ship = F.expr("(cast(round(l_extendedprice * 100) as bigint)"
                  " * cast(round(l_tax * 100) as int)) div 100")
    weight = F.col("l_quantity").cast("float")
    finite = ~F.isnan(weight) & (F.abs(weight) != F.lit(float("inf")))
    read = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_shipdate")
    return _struct(
        whole=reduce(and_, [F.col(c).isNotNull() for c in read]),
        ln=F.col("l_linenumber"), pk=F.col("l_partkey"), sk=F.col("l_suppkey"), qty=F.col("l_quantity").cast("int"),
        unit=unit.cast("int"), selling=selling.cast("int"), ship=ship.cast("int"),
        pk_text=_str(F.col("l_partkey")), tenth=_str(F.col("l_partkey") % 10),
        tax=_pct(F.col("l_tax")), returned=F.col("l_returnflag"), status=F.col("l_linestatus"),
        weight=F.when(finite, _str(weight)).otherwise(_written(weight).text),
        ship_date=F.date_format(F.col("l_shipdate"), "yyyy-MM-dd"))


def _line_text(make: Callable[..., _Text], line: Column, order_id: Column) -> Column:
    """The text that ``make`` gives for a line: for a whole one in one ``concat``, without a test of each member."""
    whole = make(line, order_id, lambda *p: _present(_number(*p)), lambda *p: _present(_string(*p)))
    return F.when(line["whole"], whole.column).otherwise(make(line, order_id, _number, _string).column)


def _item(line: Column, order_id: Column, number: Callable, string: Callable) -> _Text:
    ln, pk, sk, qty = line["ln"], line["pk"], line["sk"], line["qty"]
    pk_s, tenth = line["pk_text"], line["tenth"]
    tag = lambda flag: F.coalesce(_quoted(flag, "tag-"), F.lit("null"))
    price_tags = (F.when(ln == 1, F.lit("[]")).when(ln == 2, _null_str())
                  .when(ln == 5, _text("[", tag(line["returned"]), ",", tag(line["status"]), "]"))
                  .otherwise(_text("[", tag(line["returned"]), "]")))
    unit, selling = line["unit"], line["selling"]
    engraving = F.when(sk % 5 == 0, _null_str()).otherwise(_text('"E', _str(sk), '"'))
    content = F.when((ln == 6) | ((ln == 5) & (pk % 4 == 0)),
                     _text('{"color":"blue","engraving":', F.coalesce(engraving, F.lit("null")), "}")) \
        .otherwise(F.lit('{"color":"red"}'))
    item_attachment = F.when(ln.isin(1, 2), _null_str()).otherwise(
        _object(content=content, name='"Personalization"').column)
    attachment = lambda months: (
        '{"name":"warranty","content":{"garantia-estendida":"' + months + '"}}')
    component = lambda tag: _object(
        uniqueId=string(tag, pk_s), id=string(pk_s), quantity="1", name=string("Component ", pk_s))
    offering = lambda name, required, key, chars, domain: (
        f'[{{"name":"{name}","required":{required},"schema":{{"{key}":'
        f'{{"MaximumNumberOfCharacters":{chars},"Domain":{domain}}}}}}}]')
    category = lambda cid, prefix: _object(
        id=number(cid.cast("int")), name=string(prefix, tenth))
    first_category = category(pk % 10, "Cat")
    return _object(
        uniqueId=_Text('"', F.concat_ws("-", order_id, _str(ln), pk_s), '"'),
        id=string(pk_s),
        productId=_Maybe(F.when(pk % 97 == 0, _null_str()).otherwise(_text('"', pk_s, '"'))),
        ean=string("789", pk_s),
        itemAttachment=_Maybe(item_attachment),
        attachments=_Maybe(F.when(ln % 2 == 0, F.lit(f"[{attachment('12')},{attachment('24')}]"))),
        quantity=number(qty),
        seller='"1"',
        name=string("Part ", pk_s),
        refId=string("REF", pk_s),
        price=number(unit),
        listPrice=number(unit),
        priceTags=_Maybe(price_tags),
        imageUrl=string("/img/", pk_s, ".jpg"),
        detailUrl=string("/p/", pk_s),
        components=_Maybe(F.when(ln % 3 == 0, _text("[", component("c1-"), ",", component("c2-"), "]"))
                          .when(ln % 3 == 1, _text("[", component("c1-"), "]"))),
        params=_Maybe(F.when(sk % 2 == 1, _text('["warranty:', _str(sk % 3), '"]'))),
        offerings=F.when(ln % 2 == 1, _text("[", _object(
            type='"Warranty"', id=string("OF", tenth), name='"Warranty plan"',
            price=number((unit / 10).cast("int"))), "]")).otherwise(F.lit("[]")),
        attachmentOfferings=_Maybe(
            F.when((ln == 7) & (pk % 2 == 1), F.lit(offering("takeback", "false", "takeback", 15, '["yes","no"]')))
            .when(ln == 4, F.lit(offering("gift-note", "true", "note", 100, "[]")))),
        sellerSku=string(pk_s),
        commission="0",
        tax=number(line["tax"]),
        additionalInfo=_object(
            brandName=string("Brand", _str(pk % 20)),
            brandId=string(_str(pk % 20 + 2000)),
            categoriesIds=string("/", tenth, "/"),
            categories=F.when((ln == 7) & (pk % 2 == 0),
                              _text("[", first_category, ",", category(pk % 10 + 100, "Sub"), "]"))
            .otherwise(_text("[", first_category, "]")),
            commercialConditionId='"1"',
            dimension=_object(cubicweight="0.5", height=number(ln.cast("float")), length="10.0",
                              weight=number(line["weight"]), width="2.25")),
        measurementUnit='"un"',
        unitMultiplier="1.0",
        sellingPrice=number(selling),
        isGift="false",
        rewardValue="0",
        freightCommission="0",
        priceDefinition=_object(
            sellingPrices=_Text("[", _object(value=number(selling), quantity=number(qty)), "]"),
            calculatedSellingPrice=number(selling),
            total=number((selling * qty).cast("int"))),
        assemblies=_Maybe(F.when(ln == 3, _text(
            "[", F.coalesce(_text('"assembly-', pk_s, '"'), F.lit("null")), "]"))),
    )


def _logistics(line: Column, order_id: Column, number: Callable, string: Callable) -> _Text:
    ln, sk, qty, ship = line["ln"], line["sk"], line["qty"], line["ship"]
    third = _str(sk % 3)
    sla = lambda name, extra: _object(
        id=f'"{name}"', name=f'"{name}"', price=number((ship + F.lit(extra)).cast("int")),
        deliveryChannel='"delivery"')
    return _object(
        itemIndex=number((ln - 1).cast("int")),
        selectedSla=F.when(ln % 2 == 0, F.lit('"Express"')).otherwise(F.lit('"Normal"')),
        lockTTL='"10d"',
        price=number(ship), listPrice=number(ship), sellingPrice=number(ship),
        deliveryCompany=string("Carrier", third),
        shippingEstimate=string(_str(ln), "bd"),
        shippingEstimateDate=string(line["ship_date"]),
        slas=F.when(ln % 2 == 0, _text("[", sla("Normal", 0), ",", sla("Express", 500), "]"))
              .otherwise(_text("[", sla("Normal", 0), "]")),
        shipsTo='["BRA"]',
        deliveryIds=_Text("[", _object(
            courierId=string("C", third),
            courierName=string("Carrier", third),
            dockId='"D1"',
            quantity=number(qty),
            warehouseId=string("W", _str(sk % 4)),
            kitItemDetails=_Maybe(F.when(ln == 7, F.lit('["kit-a","kit-b"]')))), "]"),
        deliveryChannels=_Text("[", _object(id='"delivery"', stockBalance=number((qty * 10).cast("int"))), "]"),
        deliveryChannel='"delivery"',
        addressId=string("A", order_id),
        transitTime=string(_str(ln), "d"),
    )


def _metadata_item(line: Column, order_id: Column, number: Callable, string: Callable) -> _Text:
    ln, pk, pk_s = line["ln"], line["pk"], line["pk_text"]
    inputs = lambda key, chars, domain: (
        f'"{key}":{{"MaximumNumberOfCharacters":{chars},"Domain":{domain}}}')
    option = ('{"Id":"warranty","Name":"Extended warranty","Required":false,"InputValues":{'
              + inputs("takeback", 10, '["yes","no"]') + ","
              + inputs("garantia-estendida", 20, '["12m","24m","36m"]') + "}}")
    return _object(
        Id=string(pk_s), Seller='"1"', Name=string("Part ", pk_s), SkuName=string("SKU ", pk_s),
        ProductId=_Maybe(F.when(pk % 97 == 0, _null_str()).otherwise(_text('"', pk_s, '"'))),
        RefId=string("REF", pk_s), Ean=string("789", pk_s),
        ImageUrl=string("/img/", pk_s, ".jpg"), DetailUrl=string("/p/", pk_s),
        AssemblyOptions=_Maybe(F.when(ln % 4 == 1, F.lit(f"[{option}]"))))


# ---------------------------------------------------------------------------
# Order -> document
# ---------------------------------------------------------------------------

def _with_texts(customer: DataFrame) -> DataFrame:
    """Customers with the JSON texts that their orders' documents quote, made once for all orders of a customer."""
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return customer.select(
        "c_custkey", "c_nationkey", _quoted(name).alias("c_name_text"), _quoted(segment).alias("c_segment_text"),
        _quoted(F.concat(F.lower(name), F.lit("@example.com"))).alias("c_email_text"),
        (segment == "BUILDING").alias("c_is_corporate"))


def _order_document() -> Column:
    """The document of an order: for one with key and price in one ``concat``, without a test of each member."""
    whole = F.col("o_orderkey").isNotNull() & F.col("o_totalprice").isNotNull()
    text = _order_text(lambda *p: _present(_number(*p)), lambda *p: _present(_string(*p)))
    return F.when(whole, text.column).otherwise(_order_text(_number, _string).column)


def _order_text(number: Callable, string: Callable) -> _Text:
    """The text of an order; ``items``, ``logistics`` and ``metadata`` hold the texts of its lines, comma-separated.

    ``number`` and ``string`` make members from its key and price."""
    k = F.col("o_orderkey")
    k_s = _str(k)
    st = F.col("o_orderstatus")
    channel = F.col("channel_text")
    value = _cents(F.col("o_totalprice")).cast("int")
    status = (F.when(st == "F", F.lit('"invoiced"')).when(st == "O", F.lit('"canceled"'))
              .when(st == "P", F.lit('"payment-pending"')).otherwise(_quoted(st)))
    method = (F.when(k % 7 == 0, _null_str())
              .otherwise(F.element_at(
                  F.array(*[F.lit(f'"{m}"') for m in
                            ("Visa", "Mastercard", "Pix", "Boleto", "Diners")]),
                  F.substring(F.col("o_orderpriority"), 1, 1).cast("int"))))
    two_payments = k % 6 == 0
    first_value = F.when(two_payments, value - (value / 3).cast("int")).otherwise(value)
    payment = lambda i, name, amount, **more: _object(
        id=string("P", k_s, f"-{i}"),
        paymentSystem=f'"{i + 1}"',
        paymentSystemName=name,
        value=number(amount.cast("int")),
        installments=number((k % 6 + 1).cast("int")),
        referenceValue=number(amount.cast("int")),
        group='"creditCard"' if i == 0 else '"giftCard"',
        **more)
    tid = _or_null(_string("tid", k_s))
    connector = F.when(k % 10 == 0, _text(
        '{"Tid":', tid, ',"ReturnCode":', F.when(k % 20 == 0, F.lit('"0"')).otherwise(F.lit("null")), "}")) \
        .otherwise(_text('{"Tid":', tid, "}"))
    first_payment = payment(0, _Maybe(method), first_value, connectorResponses=connector)
    payments = F.when(two_payments, _text(
        "[", first_payment, ",", payment(1, '"Gift Card"', (value / 3).cast("int")), "]")) \
        .otherwise(_text("[", first_payment, "]"))
    gift_card = lambda n: _object(
        id=string(f"GC{n}-", k_s), name='"Loyalty"', value=str(1000 * n), inUse="true")
    payment_data = F.when(k % 17 == 0, _null_str()).otherwise(_object(
        giftCards=_Maybe(F.when(k % 4 == 0, _text("[", gift_card(1), ",", gift_card(2), "]"))),
        transactions=_Text("[", _object(isActive="true", transactionId=string("T", k_s),
                                        merchantName='"STORE"', payments=payments), "]")).column)
    total = lambda ident, name, amount: _object(
        id=f'"{ident}"', name=f'"{name}"', value=number(amount.cast("int")))
    totals = (F.when(k % 3 == 0, F.lit("[]"))
              .when(k % 3 == 1, _text("[", total("Items", "Items Total", value), "]"))
              .otherwise(_text("[", total("Items", "Items Total", value), ",",
                               total("Discounts", "Discounts Total", -(k % 1000)), "]")))
    rate = lambda i, **more: _object(
        description=f'"promotion {i}"', featured="true" if i == 0 else "false",
        id=f'"R{i}"', name=f'"Rate {i}"', **more)
    first_rate = rate(0, matchedParameters=_Text('{"channel":', F.coalesce(channel, F.lit("null")), "}"))
    rates = F.when(k % 7 == 0, _null_str()).otherwise(_object(
        id=string("RB", k_s),
        rateAndBenefitsIdentifiers=_Maybe(
            F.when(k % 3 == 1, _text("[", first_rate, "]"))
            .when(k % 3 == 2, _text("[", first_rate, ",", rate(1), "]")))).column)
    marketing = F.when(k % 2 == 0, _object(
        id=string("MD", k_s),
        utmSource=string("src", _str(k % 3)),
        utmMedium='"cpc"',
        utmCampaign=string("camp", _str(k % 4)),
        coupon=_Maybe(F.when(k % 6 == 0, F.lit('"CUP10"'))),
        marketingTags=F.when(k % 3 == 1, F.lit('["tag0"]')).when(k % 3 == 2, F.lit('["tag0","tag1"]'))
        .otherwise(F.lit("[]"))).column)
    cancellation = F.when(st == "O", _object(
        RequestedByUser=number(k % 2 == 0),
        Reason=_Maybe(F.when(k % 3 == 0, _null_str())
                      .otherwise(F.element_at(F.array(
                          F.lit('"Customer request"'), F.lit('"Out of stock"'),
                          F.lit('"Payment declined"'), F.lit('"Fraud suspicion"')),
                          (k % 4 + 1).cast("int")))),
        CancellationDate=_Maybe(F.when(k % 5 == 0, _null_str()).otherwise(_text(
            '"', F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS"), "yyyy-MM-dd'T'HH:mm:ss"),
            '"')))).column)
    ck = F.col("c_custkey")
    profile = F.when(ck.isNotNull(), _object(
        id=_string("CP", _str(ck)),
        email=_Maybe(F.when(ck % 50 == 0, _null_str()).otherwise(F.col("c_email_text"))),
        firstName='"Customer"',
        lastName=_string(_str(ck)),
        documentType='"cpf"',
        document=_string(_str(ck * 7)),
        phone=_string("+55", _str(F.col("c_nationkey"))),
        isCorporate=_number(F.col("c_is_corporate")),
        userProfileId=_Maybe(F.when(ck % 23 == 0, _null_str()).otherwise(_text('"', _str(ck), '"'))),
        customerClass=_Maybe(F.col("c_segment_text"))).column)
    address = _object(
        addressType='"residential"',
        receiverName=_Maybe(F.col("c_name_text")),
        addressId=string("A", k_s),
        postalCode=string(_str(k % 90000 + 10000)),
        city=string("City", _str(k % 20)),
        state=string("ST", _str(k % 5)),
        country='"BRA"',
        street=string("Street ", _str(k % 100)),
        number=string(_str(k % 1000)))
    store = F.when(k % 9 == 0, _null_str()).otherwise(_object(
        countryCode='"BRA"', currencyCode='"BRL"',
        currencyFormatInfo=_object(
            CurrencyDecimalDigits="2", CurrencyDecimalSeparator='","',
            CurrencyGroupSeparator='"."', CurrencyGroupSize="3",
            StartsWithCurrencySymbol="true"),
        currencyLocale="1046", currencySymbol='"R$"',
        timeZone='"E. South America Standard Time"').column)
    main_seller = '{"id":"1","name":"Main Store"}'
    sellers = F.when(k % 5 == 0, _text(
        f"[{main_seller},", _object(id=string("S", _str(k % 3)), name=string("Partner ", _str(k % 3))), "]")) \
        .otherwise(F.lit(f"[{main_seller}]"))
    return _object(
        orderId=string(k_s),
        sellerOrderId=string("00-", k_s),
        origin=F.when(k % 4 == 0, F.lit('"Fulfillment"')).otherwise(F.lit('"Marketplace"')),
        salesChannel=_Maybe(channel),
        status=_Maybe(status),
        workflowIsInError=number(k % 13 == 0),
        statusDescription=_Maybe(F.when(st == "F", F.lit('"Invoiced"'))
                                 .when(st == "O", F.lit('"Canceled"'))
                                 .when(st == "P", F.lit('"Payment pending"'))),
        value=number(value),
        creationDate=_written(F.col("o_orderdate")),
        lastChange=_written(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")),
        orderGroup=string("G", _str((k / 10).cast("bigint"))),
        totals=totals,
        marketplaceItems=_Maybe(F.when(k % 5 == 0, _text('["MKT-', k_s, '"]'))
                                .when(k % 5 == 1, _null_str())
                                .otherwise(F.lit("[]"))),
        clientProfileData=_Maybe(profile),
        marketingData=_Maybe(marketing),
        ratesAndBenefitsData=_Maybe(rates),
        paymentData=_Maybe(payment_data),
        packageAttachment='{"packages":[]}',
        sellers=sellers,
        followUpEmail=string("f", k_s, "@orders.example"),
        isCompleted=_Maybe(F.when(st == "F", F.lit("true")).when(st == "O", F.lit("false"))),
        storePreferencesData=_Maybe(store),
        authorizedDate=_written(F.when(k % 11 == 0, F.lit(None)).otherwise(
            F.timestamp_add("DAY", (k % 5).cast("int"), F.col("o_orderdate")))),
        cancellationData=_Maybe(cancellation),
        clientPreferencesData=_object(
            locale=F.when(k % 2 == 0, F.lit('"pt-BR"')).otherwise(F.lit('"en-US"')),
            optinNewsLetter=number(k % 3 == 0)),
        items=_Lines("[", F.col("items"), "]"),
        shippingData=_object(id=string("SD", k_s), address=address, logisticsInfo=_Lines("[", F.col("logistics"), "]")),
        itemMetadata=_Lines('{"Items":[', F.col("metadata"), "]}"))


def orders_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: Columns of ``build_keyed_bronze``: the order id as text, by which its rows are hash-partitioned, and the number
#: of its documents.
ORDER_KEY, COPIES = "order_id_text", "order_id_copies"


def build_keyed_bronze(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per order: the JSON document in ``orderDetails``, its order id in ``ORDER_KEY``, and how many
    documents have that id in ``COPIES``.

    Line items are shuffled and sorted by order as narrow columns; only then they become
    JSON text, some 8 KB an order, which passes through a window and a merge join in that
    order, so text is neither sorted nor spilled.  The order's document is one ``concat`` of its own fields'
    JSON text with these texts in it.
    """
    # Both sides are hash-partitioned on the order id text (the document's ``orderId``)
    # into an explicit number of partitions, the session's shuffle partitions: the
    # per-order aggregate and the sort-merge join reuse that partitioning, AQE does not
    # coalesce these CPU-heavy tasks (JSON out, and the parse right after it), and the
    # documents come out partitioned exactly as a table bucketed on ``orderId``.
    parts = orders_partitions(tables["orders"])
    texts = {"items": _item, "logistics": _logistics, "metadata": _metadata_item}
    in_order = Window.partitionBy("line_order_id").orderBy("l_linenumber")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_order = (tables["lineitem"]
                 .where(F.col("l_orderkey").isNotNull())
                 .withColumn("line_order_id", F.col("l_orderkey").cast("string"))
                 .repartition(parts, "line_order_id")
                 .sortWithinPartitions("line_order_id", "l_linenumber")
                 .withColumn("line", _line())
                 .select("line_order_id", "l_linenumber",
                         *(_line_text(text, F.col("line"), F.col("line_order_id")).alias(name)
                           for name, text in texts.items()))
                 .select("line_order_id",
                         *(F.listagg(name, F.lit(",")).over(whole).alias(name) for name in texts),
                         F.row_number().over(in_order).alias("row"))
                 .where("row = 1").drop("row"))
    orders = (tables["orders"]
              .join(_with_texts(tables["customer"]), F.col("o_custkey") == F.col("c_custkey"), "left")
              .withColumn("channel_text", _quoted(F.col("o_orderpriority")))
              .withColumn(ORDER_KEY, F.col("o_orderkey").cast("string"))
              .repartition(parts, ORDER_KEY)
              .withColumn(COPIES, F.count(F.lit(1)).over(Window.partitionBy(ORDER_KEY))))
    # Sort-merge join on the order id: both sides are partitioned on it already, and lines
    # sorted, so neither is shuffled again nor broadcast (per-order items grow with the data).
    docs = orders.join(per_order.hint("merge"),
                       F.col(ORDER_KEY) == F.col("line_order_id"), "left")
    return docs.select(ORDER_KEY, COPIES, evaluated_once(_order_document()).alias("orderDetails"))


def build_bronze(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per order with the JSON document in ``orderDetails``."""
    return build_keyed_bronze(tables).select("orderDetails")


def keyed_bronze_from_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_keyed_bronze(load_tables(spark, sf_dir))


def bronze_from_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_bronze(load_tables(spark, sf_dir))
