"""The conformed tables: 37 entities in build order and 16 bridges.

Fixed values: table names, column names, types, references and accepted values of the records.
"""

from __future__ import annotations

from collections.abc import Mapping

from plenaria.operators.merge import ForeignKey
from plenaria.plans.conform import BridgeSpec, EntitySpec, entity

_SEAT = "functie van~ tot_en_met~end"
_CONTACT = "soort waarde gewicht:int"
_PUBLICATION = ("content_type content_length:long identifier document_type file_name source publicatie_datum:date "
                "url document_url@ document_versie_id>document_versie")

ACCEPTED = {
    "toezegging": (("status", ("Openstaand", "Voldaan", "Deels Voldaan", "Vervallen", "Afgedaan", "Deels Afgedaan")),),
    "persoon": (("geslacht", ("man", "vrouw", "x")),
                ("functie", ("Eerste Kamerlid", "Oud Kamerlid", "Tweede Kamerlid"))),
    "persoon_contactinformatie": (
        ("soort", ("E-mail", "Facebook", "Instagram", "LinkedIn", "Twitter", "Website", "X", "Bluesky")),),
    "persoon_nevenfunctie_inkomsten": (
        ("bedrag_soort", ("Bruto", "Netto", "Onbekend")),
        ("frequentie", ("Eenmalig", "Per dag", "Per jaar", "Per maand", "Vrije invoer"))),
}

LAYOUTS: dict[str, str] = {
    "commissie": "nummer soort afkorting naam_nl naam_en naam_web_nl naam_web_en inhoudsopgave "
                 "datum_actief~ datum_inactief~end",
    "activiteit": "soort nummer onderwerp datum_soort datum:date aanvangstijd:ts eindtijd:ts locatie besloten:bool status "
                  "vergaderjaar kamer noot vrs_nummer sid_voortouw voortouwnaam voortouwafkorting voortouwkortenaam "
                  "voortouwcommissie_id>commissie aanvraagdatum:date datum_verzoek_eerste_verlenging:date "
                  "datum_mededeling_eerste_verlenging:date datum_verzoek_tweede_verlenging:date "
                  "datum_mededeling_tweede_verlenging:date vervaldatum:date",
    "fractie": "nummer afkorting naam_nl naam_en aantal_zetels:int aantal_stemmen:int datum_actief~ datum_inactief~end "
               "logo_url@ content_type content_length:int",
    "persoon": "nummer titels initialen tussenvoegsel achternaam voornamen roepnaam geslacht functie geboortedatum~ "
               "geboorteplaats geboorteland overlijdensdatum~ overlijdensplaats woonplaats land fractielabel "
               "portret_url@ content_type content_length:int",
    "activiteit_actor": "activiteit_id>activiteit commissie_id>commissie persoon_id>persoon fractie_id>fractie actor_naam "
                        "actor_fractie relatie volgorde:int functie spreektijd sid_actor",
    "agendapunt": "activiteit_id>activiteit nummer onderwerp aanvangstijd:ts eindtijd:ts volgorde:int rubriek noot status",
    "besluit": "agendapunt_id>agendapunt stemmings_soort besluit_soort besluit_tekst opmerking status "
               "agendapunt_zaak_besluit_volgorde:int",
    "kamerstukdossier": "titel citeertitel alias nummer:int toevoeging hoogste_volgnummer:int afgesloten:bool kamer",
    "zaak": "nummer soort onderwerp gestart_op:date organisatie titel citeertitel alias grondslagvoorhang termijn:ts "
            "vergaderjaar volgnummer:int status afgedaan:bool groot_project:bool kabinetsappreciatie "
            "kamerstukdossier_id>kamerstukdossier",
    "commissie_contactinformatie": f"commissie_id>commissie {_CONTACT}",
    "commissie_zetel": "commissie_id>commissie gewicht:int",
    "commissie_zetel_vast_persoon": f"commissie_zetel_id>commissie_zetel persoon_id>persoon {_SEAT}",
    "commissie_zetel_vast_vacature": f"commissie_zetel_id>commissie_zetel fractie_id>fractie {_SEAT}",
    "commissie_zetel_vervanger_persoon": f"commissie_zetel_id>commissie_zetel persoon_id>persoon {_SEAT}",
    "commissie_zetel_vervanger_vacature": f"commissie_zetel_id>commissie_zetel fractie_id>fractie {_SEAT}",
    "document": "content_type content_length:long soort document_nummer titel onderwerp datum:date volgnummer:long "
                "vergaderjaar kamer:long datum_registratie:date datum_ontvangst:date organisatie "
                "kamerstukdossier_id>kamerstukdossier huidige_document_versie_id>document_versie kenmerk_afzender "
                "aanhangselnummer alias citeertitel document_url@",
    "document_actor": "actor_naam functie relatie sid_actor persoon_id>persoon document_id>document actor_fractie "
                      "fractie_id>fractie",
    "document_versie": "status versienummer:long bestandsgrootte:long extensie datum:date externeidentifier "
                       "document_id>document",
    "document_publicatie": _PUBLICATION,
    "document_publicatie_metadata": _PUBLICATION,
    "fractie_zetel": "fractie_id>fractie gewicht:int",
    "fractie_zetel_persoon": f"fractie_zetel_id>fractie_zetel persoon_id>persoon {_SEAT}",
    "fractie_zetel_vacature": f"fractie_zetel_id>fractie_zetel {_SEAT}",
    "persoon_contactinformatie": f"persoon_id>persoon {_CONTACT}",
    "persoon_geschenk": "persoon_id>persoon omschrijving datum~ gewicht:int",
    "persoon_loopbaan": "persoon_id>persoon functie werkgever omschrijving_nl omschrijving_en plaats van~ tot_en_met~end "
                        "gewicht:int",
    "persoon_nevenfunctie": "persoon_id>persoon omschrijving is_actief:bool periode_van=periode.van~ "
                            "periode_tot_en_met=periode.tot_en_met~end vergoeding_soort=vergoeding.soort "
                            "vergoeding_toelichting=vergoeding.toelichting gewicht:int",
    "persoon_nevenfunctie_inkomsten": "persoon_nevenfunctie_id>persoon_nevenfunctie jaar:int bedrag_soort "
                                      "bedrag_voorvoegsel bedrag_valuta bedrag:dec bedrag_achtervoegsel frequentie "
                                      "frequentie_beschrijving opmerking",
    "persoon_onderwijs": "persoon_id>persoon opleiding_nl opleiding_en instelling plaats van~ tot_en_met~end gewicht:int",
    "persoon_reis": "persoon_id>persoon doel bestemming van~ tot_en_met~end betaald_door gewicht:int",
    "zaal": "naam sys_code:int",
    "reservering": "activiteit_id>>activiteit zaal_id>zaal nummer activiteit_nummer status_code status_naam",
    "stemming": "besluit_id>besluit soort fractie_grootte:int actor_naam actor_fractie vergissing:bool sid_actor_lid "
                "sid_actor_fractie persoon_id>persoon fractie_id>fractie",
    "toezegging": "aanmaakdatum:date nummer activiteit_id>activiteit activiteit_nummer naam achternaam initialen "
                  "tussenvoegsel voornaam achtervoegsel titulatuur functie status datum_nakoming:date ministerie tekst",
    "vergadering": "soort titel zaal vergaderjaar vergadering_nummer:int datum:date aanvangstijd:ts sluiting:ts kamer",
    "verslag": "vergadering_id>vergadering soort status content_type content_length:int xml_url@",
    "zaak_actor": "zaak_id>zaak persoon_id>persoon fractie_id>fractie commissie_id>commissie actor_naam actor_fractie "
                  "actor_afkorting functie relatie sid_actor",
}

ENTITIES: dict[str, EntitySpec] = {n: entity(n, layout, ACCEPTED.get(n, ())) for n, layout in LAYOUTS.items()}


def _bridge(name: str, owner: str, relation: str, column: str, parent: str, **more) -> BridgeSpec:
    return BridgeSpec(name, owner, relation, f"{owner}_id", {column: ("ref", parent)}, **more)


BRIDGES: dict[str, BridgeSpec] = {b.name: b for b in [
    _bridge("activiteit_vervangen_vanuit", "activiteit", "vervangen_vanuit", "vervangen_vanuit_id", "activiteit"),
    _bridge("activiteit_voortgezet_vanuit", "activiteit", "voortgezet_vanuit", "voortgezet_vanuit_id", "activiteit"),
    _bridge("besluit_zaak", "besluit", "zaak", "zaak_id", "zaak"),
    _bridge("document_activiteit", "document", "activiteit", "activiteit_id", "activiteit"),
    _bridge("document_agendapunt", "document", "agendapunt", "agendapunt_id", "agendapunt"),
    _bridge("document_bron_document", "document", "bron_document", "bron_document_id", "document"),
    _bridge("document_zaak", "document", "zaak", "zaak_id", "zaak"),
    _bridge("toezegging_is_aanvulling_op", "toezegging", "is_aanvulling_op", "aanvulling_op_id", "toezegging", stamp="item"),
    _bridge("toezegging_is_herhaling_van", "toezegging", "is_herhaling_van", "herhaling_van_id", "toezegging", stamp="item"),
    _bridge("toezegging_is_wijziging_van", "toezegging", "is_wijziging_van", "wijziging_van_id", "toezegging", stamp="item"),
    _bridge("toezegging_kamerbrief_nakoming", "toezegging", "kamerbrief_nakoming", "document_id", "document"),
    BridgeSpec("toezegging_toegezegd_aan", "toezegging", "toegezegd_aan", "toezegging_id",
               {"persoon_id": ("persoon.ref", "persoon"), "fractie_id": ("fractie.ref", "fractie")}, ordered=True),
    _bridge("zaak_activiteit", "zaak", "activiteit", "activiteit_id", "activiteit"),
    _bridge("zaak_agendapunt", "zaak", "agendapunt", "agendapunt_id", "agendapunt"),
    _bridge("zaak_gerelateerd_vanuit", "zaak", "gerelateerd_vanuit", "gerelateerd_vanuit_id", "zaak"),
    _bridge("zaak_vervangen_vanuit", "zaak", "vervangen_vanuit", "vervangen_vanuit_id", "zaak"),
]}


def foreign_keys() -> list[ForeignKey]:
    """Every declared reference of the conformed tables."""
    found = [ForeignKey(n, c, p) for n, s in ENTITIES.items() for c, p in s.references.items()]
    for name, bridge in BRIDGES.items():
        found.append(ForeignKey(name, bridge.owner_id, bridge.owner))
        found += [ForeignKey(name, c, p) for c, (_, p) in bridge.targets.items()]
    return found


def relations_of(entity_name: str) -> Mapping[str, BridgeSpec]:
    """The bridges that live inside an entity's row, by relation column."""
    return {b.relation: b for b in BRIDGES.values() if b.owner == entity_name}
