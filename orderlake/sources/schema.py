"""Declared schema of one order document (the bronze ``orderDetails`` JSON text).

The schema is written as Spark DDL so that ``from_json`` can take it directly and a
session can turn it into a ``StructType`` with ``StructType.fromDDL``.  Sub-schemas that
occur more than once are composed from shared fragments.

Fixed values: every field name, its nesting and its type below must equal the source
document layout, because the silver tables take their column names from them.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql.types import StructType

# ---------------------------------------------------------------------------
# Document field names and types, in document order.
# ---------------------------------------------------------------------------

CANCELLATION_DATA = """STRUCT<
    RequestedByUser: BOOLEAN,
    RequestedBySystem: STRING,
    RequestedBySellerNotification: STRING,
    RequestedByPaymentNotification: STRING,
    Reason: STRING,
    CancellationDate: STRING>"""

GIFT_CARD = """STRUCT<
    id: STRING, redemptionCode: STRING, name: STRING, caption: STRING,
    value: BIGINT, balance: BIGINT, provider: STRING, groupName: STRING,
    inUse: BOOLEAN, isSpecialCard: BOOLEAN>"""

RATE_AND_BENEFITS_IDENTIFIER = """STRUCT<
    description: STRING, featured: BOOLEAN, id: STRING, name: STRING,
    matchedParameters: MAP<STRING, STRING>, additionalInfo: STRING>"""

DIMENSION = """STRUCT<
    cubicweight: FLOAT, height: FLOAT, length: FLOAT, weight: FLOAT, width: FLOAT>"""

ITEM_ATTACHMENT = "STRUCT<content: MAP<STRING, STRING>, name: STRING>"

ATTACHMENT = """STRUCT<
    name: STRING NOT NULL,
    content: STRUCT<`garantia-estendida`: STRING> NOT NULL>"""

COMPONENT = f"""STRUCT<
    uniqueId: STRING, id: STRING, productId: STRING, ean: STRING, lockId: STRING,
    itemAttachment: {ITEM_ATTACHMENT},
    attachments: ARRAY<STRING>,
    quantity: INT, seller: STRING, name: STRING, refId: STRING,
    price: BIGINT, listPrice: BIGINT, manualPrice: BIGINT,
    priceTags: ARRAY<STRING>, imageUrl: STRING, detailUrl: STRING,
    components: ARRAY<STRING>, bundleItems: ARRAY<STRING>, params: ARRAY<STRING>,
    offerings: ARRAY<STRING>, attachmentOfferings: ARRAY<STRING>,
    sellerSku: STRING, priceValidUntil: STRING, commission: INT, tax: INT,
    preSaleDate: STRING,
    additionalInfo: STRUCT<
        brandName: STRING, brandId: STRING, categoriesIds: STRING, categories: STRING,
        productClusterId: STRING, commercialConditionId: STRING,
        dimension: {DIMENSION},
        offeringInfo: STRING, offeringType: STRING, offeringTypeId: STRING>,
    measurementUnit: STRING, unitMultiplier: FLOAT, sellingPrice: BIGINT,
    isGift: BOOLEAN, shippingPrice: BIGINT, rewardValue: INT, freightCommission: INT,
    priceDefinition: STRUCT<
        sellingPrices: ARRAY<STRUCT<value: BIGINT, quantity: INT>>,
        calculatedSellingPrice: BIGINT, total: BIGINT, reason: STRING>,
    taxCode: STRING, parentItemIndex: STRING, parentAssemblyBinding: STRING,
    callCenterOperator: STRING, serialNumbers: STRING, assemblies: ARRAY<STRING>,
    costPrice: BIGINT>"""

BUNDLE_ITEM = f"""STRUCT<
    uniqueId: STRING, id: STRING, productId: STRING, ean: STRING, lockId: STRING,
    itemAttachment: {ITEM_ATTACHMENT},
    attachments: ARRAY<STRING>,
    quantity: INT, seller: STRING, name: STRING, refId: STRING,
    price: INT, listPrice: INT, manualPrice: INT,
    priceTags: ARRAY<STRING>, imageUrl: STRING, detailUrl: STRING,
    components: ARRAY<STRING>, bundleItems: ARRAY<STRING>, params: ARRAY<STRING>,
    offerings: ARRAY<STRING>,
    attachmentOfferings: ARRAY<STRUCT<
        name: STRING, required: BOOLEAN,
        schema: STRUCT<takeback: STRUCT<MaximumNumberOfCharacters: INT, Domain: ARRAY<STRING>>>>>,
    sellerSku: STRING, priceValidUntil: STRING, commission: INT, tax: INT,
    preSaleDate: STRING,
    additionalInfo: STRUCT<
        brandName: STRING, brandId: STRING, categoriesIds: STRING, categories: STRING,
        productClusterId: STRING, commercialConditionId: STRING, dimension: STRING,
        offeringInfo: STRING, offeringType: STRING, offeringTypeId: STRING>,
    measurementUnit: STRING, unitMultiplier: FLOAT, sellingPrice: INT,
    isGift: BOOLEAN, shippingPrice: INT, rewardValue: INT, freightCommission: INT,
    priceDefinition: STRING, taxCode: STRING, parentItemIndex: STRING,
    parentAssemblyBinding: STRING, callCenterOperator: STRING, serialNumbers: STRING,
    assemblies: ARRAY<STRING>, costPrice: INT>"""

SUBSCRIPTION_DATA = """STRUCT<
    SubscriptionGroupId: STRING,
    Subscriptions: ARRAY<STRUCT<
        ExecutionCount: INT, PriceAtSubscriptionDate: INT, ItemIndex: INT,
        Plan: STRUCT<
            type: STRING,
            frequency: STRUCT<periodicity: STRING, interval: INT>,
            validity: STRUCT<begin: STRING, `end`: STRING>>>>>"""

ITEM = f"""STRUCT<
    uniqueId: STRING, id: STRING, productId: STRING, ean: STRING, lockId: STRING,
    itemAttachment: {ITEM_ATTACHMENT},
    attachments: ARRAY<{ATTACHMENT}>,
    quantity: INT, seller: STRING, name: STRING, refId: STRING,
    price: INT, listPrice: INT, manualPrice: STRING,
    priceTags: ARRAY<STRING>, imageUrl: STRING, detailUrl: STRING,
    components: ARRAY<{COMPONENT}>,
    bundleItems: ARRAY<{BUNDLE_ITEM}>,
    params: ARRAY<STRING>,
    offerings: ARRAY<STRUCT<type: STRING, id: STRING, name: STRING, price: INT>>,
    attachmentOfferings: ARRAY<STRUCT<
        name: STRING, required: BOOLEAN,
        schema: MAP<STRING, STRUCT<MaximumNumberOfCharacters: INT, Domain: ARRAY<STRING>>>>>,
    sellerSku: STRING, priceValidUntil: STRING, commission: INT, tax: INT,
    preSaleDate: STRING,
    additionalInfo: STRUCT<
        brandName: STRING, brandId: STRING, categoriesIds: STRING,
        categories: ARRAY<STRUCT<id: INT, name: STRING>>,
        productClusterId: STRING, commercialConditionId: STRING,
        dimension: {DIMENSION},
        offeringInfo: STRING, offeringType: STRING, offeringTypeId: STRING>,
    measurementUnit: STRING, unitMultiplier: FLOAT, sellingPrice: INT,
    isGift: BOOLEAN, shippingPrice: STRING, rewardValue: INT, freightCommission: INT,
    priceDefinition: STRUCT<
        sellingPrices: ARRAY<STRUCT<value: INT, quantity: INT>>,
        calculatedSellingPrice: INT, total: INT, reason: STRING>,
    taxCode: STRING, parentItemIndex: STRING, parentAssemblyBinding: STRING,
    callCenterOperator: STRING, serialNumbers: STRING, assemblies: ARRAY<STRING>,
    costPrice: INT>"""

ADDRESS_FIELDS = """
    addressType: STRING, receiverName: STRING, addressId: STRING, versionId: STRING,
    entityId: STRING, postalCode: STRING, city: STRING, state: STRING,
    country: STRING, street: STRING, number: STRING, neighborhood: STRING,
    complement: STRING, reference: STRING, geoCoordinates: ARRAY<FLOAT>"""

SLA = f"""STRUCT<
    id: STRING, name: STRING, shippingEstimate: STRING, deliveryWindow: STRING,
    price: INT, deliveryChannel: STRING,
    pickupStoreInfo: STRUCT<
        additionalInfo: STRING,
        address: STRUCT<{ADDRESS_FIELDS}>,
        dockId: STRING, friendlyName: STRING, isPickupStore: BOOLEAN>,
    polygonName: STRING, lockTTL: STRING, pickupPointId: STRING,
    transitTime: STRING, pickupDistance: FLOAT>"""

LOGISTICS_INFO = f"""STRUCT<
    itemIndex: INT, selectedSla: STRING, lockTTL: STRING,
    price: INT, listPrice: INT, sellingPrice: INT,
    deliveryWindow: STRING, deliveryCompany: STRING,
    shippingEstimate: STRING, shippingEstimateDate: STRING,
    slas: ARRAY<{SLA}>,
    shipsTo: ARRAY<STRING>,
    deliveryIds: ARRAY<STRUCT<
        courierId: STRING, courierName: STRING, dockId: STRING, quantity: INT,
        warehouseId: STRING, accountCarrierName: STRING, kitItemDetails: ARRAY<STRING>>>,
    deliveryChannels: ARRAY<STRUCT<id: STRING, stockBalance: INT>>,
    deliveryChannel: STRING,
    pickupStoreInfo: STRUCT<
        additionalInfo: STRING, address: STRING, dockId: STRING,
        friendlyName: STRING, isPickupStore: BOOLEAN>,
    addressId: STRING, versionId: STRING, entityId: STRING,
    polygonName: STRING, pickupPointId: STRING, transitTime: STRING>"""

SELECTED_ADDRESS = """STRUCT<
    addressId: STRING, versionId: STRING, entityId: STRING, addressType: STRING,
    receiverName: STRING, street: STRING, number: STRING, complement: STRING,
    neighborhood: STRING, postalCode: STRING, city: STRING, state: STRING,
    country: STRING, reference: STRING, geoCoordinates: ARRAY<FLOAT>>"""

PAYMENT = """STRUCT<
    id: STRING, paymentSystem: STRING, paymentSystemName: STRING, value: INT,
    installments: INT, referenceValue: INT, cardHolder: STRING, cardNumber: STRING,
    firstDigits: STRING, lastDigits: STRING, cvv2: STRING, expireMonth: STRING,
    expireYear: STRING, url: STRING, giftCardId: STRING, giftCardName: STRING,
    giftCardCaption: STRING, redemptionCode: STRING, `group`: STRING, tid: STRING,
    dueDate: STRING, connectorResponses: MAP<STRING, STRING>,
    giftCardProvider: STRING, giftCardAsDiscount: STRING, koinUrl: STRING,
    accountId: STRING, parentAccountId: STRING,
    bankIssuedInvoiceIdentificationNumber: STRING,
    bankIssuedInvoiceIdentificationNumberFormatted: STRING,
    bankIssuedInvoiceBarCodeNumber: STRING, bankIssuedInvoiceBarCodeType: STRING,
    billingAddress: STRING, paymentOrigin: STRING>"""

DOMAIN_INPUT = "STRUCT<MaximumNumberOfCharacters: INT, Domain: ARRAY<STRING>>"

ORDER_DOCUMENT_DDL = f"""
orderId STRING, sequence STRING, marketplaceOrderId STRING,
marketplaceServicesEndpoint STRING, sellerOrderId STRING, origin STRING,
affiliateId STRING, salesChannel STRING, merchantName STRING, status STRING,
workflowIsInError BOOLEAN, statusDescription STRING, value INT,
creationDate TIMESTAMP, lastChange TIMESTAMP, orderGroup STRING,
totals ARRAY<STRUCT<id: STRING, name: STRING, value: INT>>,
items ARRAY<{ITEM}>,
marketplaceItems ARRAY<STRING>,
clientProfileData STRUCT<
    id: STRING, email: STRING, firstName: STRING, lastName: STRING,
    documentType: STRING, document: STRING, phone: STRING, corporateName: STRING,
    tradeName: STRING, corporateDocument: STRING, stateInscription: STRING,
    corporatePhone: STRING, isCorporate: BOOLEAN, userProfileId: STRING,
    userProfileVersion: STRING, customerClass: STRING>,
giftRegistryData STRING,
marketingData STRUCT<
    id: STRING, utmSource: STRING, utmPartner: STRING, utmMedium: STRING,
    utmCampaign: STRING, coupon: STRING, utmiCampaign: STRING, utmipage: STRING,
    utmiPart: STRING, marketingTags: ARRAY<STRING>>,
ratesAndBenefitsData STRUCT<
    id: STRING, rateAndBenefitsIdentifiers: ARRAY<{RATE_AND_BENEFITS_IDENTIFIER}>>,
shippingData STRUCT<
    id: STRING,
    address: STRUCT<{ADDRESS_FIELDS}>,
    logisticsInfo: ARRAY<{LOGISTICS_INFO}>,
    trackingHints: STRING,
    selectedAddresses: ARRAY<{SELECTED_ADDRESS}>>,
paymentData STRUCT<
    giftCards: ARRAY<{GIFT_CARD}>,
    transactions: ARRAY<STRUCT<
        isActive: BOOLEAN, transactionId: STRING, merchantName: STRING,
        payments: ARRAY<{PAYMENT}>>>>,
packageAttachment STRUCT<packages: ARRAY<STRING>>,
sellers ARRAY<STRUCT<id: STRING, name: STRING, logo: STRING, fulfillmentEndpoint: STRING>>,
callCenterOperatorData STRING, followUpEmail STRING, lastMessage STRING,
hostname STRING,
invoiceData STRUCT<
    userPaymentInfo: STRING,
    address: STRUCT<
        postalCode: STRING, city: STRING, state: STRING, country: STRING,
        street: STRING, number: STRING, neighborhood: STRING, complement: STRING,
        reference: STRING, geoCoordinates: ARRAY<DOUBLE>>,
    invoiceSubject: STRING>,
changesAttachment STRING, openTextField STRING, roundingError INT,
orderFormId STRING, commercialConditionData STRING, isCompleted BOOLEAN,
customData STRING,
storePreferencesData STRUCT<
    countryCode: STRING, currencyCode: STRING,
    currencyFormatInfo: STRUCT<
        CurrencyDecimalDigits: INT, CurrencyDecimalSeparator: STRING,
        CurrencyGroupSeparator: STRING, CurrencyGroupSize: INT,
        StartsWithCurrencySymbol: BOOLEAN>,
    currencyLocale: INT, currencySymbol: STRING, timeZone: STRING>,
allowCancellation BOOLEAN, allowEdition BOOLEAN, isCheckedIn BOOLEAN,
marketplace STRUCT<baseURL: STRING, isCertified: STRING, name: STRING>,
authorizedDate TIMESTAMP, invoicedDate STRING, cancelReason STRING,
itemMetadata STRUCT<
    Items: ARRAY<STRUCT<
        Id: STRING, Seller: STRING, Name: STRING, SkuName: STRING,
        ProductId: STRING, RefId: STRING, Ean: STRING, ImageUrl: STRING,
        DetailUrl: STRING,
        AssemblyOptions: ARRAY<STRUCT<
            Id: STRING, Name: STRING, Required: BOOLEAN,
            InputValues: STRUCT<takeback: {DOMAIN_INPUT}, `garantia-estendida`: {DOMAIN_INPUT}>,
            Composition: STRING>>>>>,
subscriptionData {SUBSCRIPTION_DATA},
taxData STRING, checkedInPickupPointId STRING,
cancellationData {CANCELLATION_DATA},
clientPreferencesData STRUCT<locale: STRING, optinNewsLetter: BOOLEAN>
"""

# Outer bronze record: one JSON line per order, the document kept as text.
BRONZE_DDL = "orderDetails STRING"


@lru_cache(maxsize=1)
def _parsed(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def order_document_schema() -> StructType:
    """The document schema as a ``StructType`` (needs an active SparkSession)."""
    return _parsed(" ".join(ORDER_DOCUMENT_DDL.split()))
