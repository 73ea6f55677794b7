"""Source schemas. Dirty sources are read as text; typing happens in the cleaning rules."""

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


ORDERS = _text(
    "id_commande", "id_client", "id_produit", "date_commande", "quantite", "prix_unitaire",
    "statut", "ville_livraison", "mode_paiement", "id_livreur", "date_livraison",
)
CLIENTS = _text(
    "id_client", "nom", "prenom", "email", "date_naissance", "sexe", "ville",
    "telephone", "date_inscription", "canal_acquisition",
)
PRODUCTS = _text(
    "id_produit", "nom", "categorie", "sous_categorie", "marque", "fournisseur",
    "prix_catalogue", "origine_pays", "date_creation", "actif",
)
REGIONS = T.StructType(
    [
        T.StructField("code_ville", T.StringType()),
        T.StructField("nom_ville_standard", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("region_admin", T.StringType()),
        T.StructField("zone_geo", T.StringType()),
        T.StructField("population", T.LongType()),
        T.StructField("code_postal", T.StringType()),
    ]
)
OFFERS = T.StructType(
    _text(
        "id_offre", "source", "titre_poste", "description", "competences_brut", "entreprise", "ville",
        "type_contrat", "experience_requise", "salaire_brut", "niveau_etudes", "secteur",
        "date_publication", "date_expiration",
    ).fields
    + [
        T.StructField("nb_postes", T.LongType()),
        T.StructField("teletravail", T.StringType()),
        T.StructField("langue_requise", T.ArrayType(T.StringType())),
    ]
)
SKILLS = T.StructType(
    [T.StructField("familles", T.MapType(T.StringType(), T.MapType(T.StringType(), T.ArrayType(T.StringType()))))]
)
