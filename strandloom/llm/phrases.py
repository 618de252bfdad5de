"""Wordings of error pages, script notices and placeholder text, by language, as rules.

``(a|b|)`` stands for each of its parts.  The first list of a language holds *telling* phrases, by
which a sentence is suspected; the second the plain words such sentences are made of, which only
add to the coverage of a suspected sentence.  They were written from general knowledge of web
servers, browsers, hosting pages and page templates, not from any table.
"""

from __future__ import annotations

import re

_SCRIPTS = "(javascript|java script|js|scripts|scripting|client-side scripts|cookies)"
ENGLISH = f"""
not found; (could not|cannot|can not|can't|couldn't|could n't|was not|wasn't|were not) (be |)(found|shown|displayed|loaded|opened|rendered|reached|located|retrieved|processed|completed|accessed)
(could not|cannot|can't|couldn't|unable to|failed to|were unable to|are unable to|not able to) (find|load|open|show|display|render|reach|locate|retrieve|connect|fetch|process); (does not|doesn't|no longer|did not) (exist|exists|respond|load)
(is|are|was|currently|temporarily|no longer|not|service|server|site) (temporarily |currently |no longer |not |un)available; isn't available; is not here (any more|anymore|any longer); nothing (here|to see here)
(has been|have been|was|were|been|may have been|might have been) (moved|removed|deleted|taken down|renamed|archived|disabled|suspended|withdrawn); moved or (deleted|removed); taken (down|offline)
access (denied|forbidden|restricted|is denied|is forbidden|to this); permission denied; (don't|do not|doesn't|does not) have (permission|access|the rights|sufficient rights); need permission; (not|aren't|isn't|are not|is not) (authorized|authorised|allowed|permitted) to
(unauthorized|forbidden|bad request|bad gateway|gateway (timeout|time-out|timed out)|request (timeout|time-out|timed out|blocked|rejected|entity too large)|method not allowed|payload too large|too many requests|not acceptable|not implemented|internal (server |)error|server error|database error|fatal error|http error|proxy error|service temporarily unavailable|upstream (timed out|error))
error (code|id|number|page|establishing a database connection|400|401|403|404|408|410|429|500|502|503|504); (400|401|403|404|408|410|429|500|502|503|504) (error|not found|forbidden|unauthorized|bad|gone|internal|gateway|service|too many); an (error|internal error|unexpected error|unknown error|unexpected condition|unexpected problem)
error (occurred|has occurred|happened); unexpected (error|condition|problem); (something|things) (went wrong|broke|is broken|has gone wrong); having (trouble|problems|difficulties); (ran into|encountered) (a|an) (problem|error|issue)
(took|takes|taking) too long; (did not|didn't|does not|doesn't|not) (answer|answering|respond|responding) (in time|); timed out; no response from; (connection|session|request|link|page|login) (was |has |is |)(reset|refused|closed|lost|expired|timed out|ended|broken|invalid)
too (many|big|large|long) (requests|visitors|users|connections|attempts|people|to be|to display|to render|to show); (rate|quota|bandwidth|usage|request) limit (exceeded|reached); (quota|limit|bandwidth) exceeded; slow down
(try|please try|check|come|visit) (again|back|later|again later|back later|back soon); (reload|refresh) (the|this) page; retry (later|in); contact (the|your|an|our) (administrator|webmaster|support|owner|site owner|system administrator); report (this|the) (problem|error)
(under|down for|scheduled|for|undergoing) (maintenance|construction); be (right back|back soon|back shortly); (log|sign) (in|on) (again |)(to|or) (continue|view|see|access|read|register|your); (please|you must|you need to|must be) (log|sign|logged|signed) (in|on)
(check|checking|verify|verifying) your browser; (verify|prove|confirm) (that |)you are (human|not a robot); unusual traffic; captcha; (browser|client|device) (is |)(not supported|unsupported|outdated|out of date|too old); (unsupported|outdated) browser; (update|upgrade) your browser; (site|page|server) can't be reached
(link|url|address|page|site) (you|is|may be|might be|has) (followed|broken|incorrect|invalid|mistyped|wrong|misspelled|expired); the requested (url|page|resource|file|document|notebook|address); (page|file|document|notebook|resource|content|url) you (requested|asked for|are looking for|were looking for|tried to reach|tried to open|followed)
(enable|activate|allow|permit|unblock|turn on|switch on|re-enable) (your browser's |)(java|)script; (enable|activate|allow|unblock|turn on|switch on|requires|require|needs|need|blocks|blocking|without|supports|support) {_SCRIPTS}; (turn|switch) {_SCRIPTS} (back |)on; {_SCRIPTS} (is |are |has been |have been |was |must be |to be |needs to be |need to be |should be |seems to be |appears to be |)(required|needed|disabled|enabled|blocked|off|turned off|switched off|on|turned on|switched on|deactivated|not enabled|not supported|not available|allowed); <noscript>
lorem ipsum; dolor sit amet; consectetur adipiscing; (placeholder|dummy|sample|filler|example|boilerplate|blind|mock) (text|copy|paragraph|content|title|heading|caption|sentence|description); (sample|dummy|placeholder) (text|data|content) (only|here)
(text|title|heading|content|copy|caption|body|body copy|name|abstract|figure|table|image|summary|description|introduction|conclusion|author|date|paragraph|subtitle|details|code|link|logo) (goes|to go|comes|to come|to follow|follows|will go|will be added|will appear|belongs|should go) (here|); your (own |)(text|title|name|content|heading|caption|description|message|logo|code) here
(insert|add|put|place|type|enter|write|paste|describe|provide|summarize|summarise) (a |the |your |some |)(text|title|heading|content|caption|name|abstract|figure|table|image|summary|description|introduction|conclusion|author|date|paragraph|section|results|dataset|data|link|references) (here|below)
(replace|overwrite|change|delete|remove) (this|the) (text|paragraph|section|sentence|placeholder|content|heading|title|line|caption|block|instruction|instructions|example) (with|by|before|and|when|once|); with your own; (to be|will be) (written|completed|added|filled in|announced|determined|decided|defined|provided|done); (section|text|content|part|page|chapter) to (be|come|follow); coming soon; (click|double-click|tap) (here |)to (edit|add|change|type|enter); (fill|complete) (in |out |)(this|the) (section|part|text|blank|blanks|template|form|field|fields|placeholder); todo: (fill|write|add|describe|complete|insert)
"""
ENGLISH_PLAIN = """
a an the this that these those need needs needed turn turning switch you your yours we our us i it its he is are was were be been being has have had do does did may might can could will would should must cannot can't don't not no or and but if then when while for from to of on in at by with as so too yet again here there now later soon please sorry oops uh whoops ouch dear hello hi hey
page pages site website file files notebook notebooks document documents resource content contents link links url address server host browser client web internet network connection request requests requested response account user users visitor visitors people session login password owner author administrator admin support team help home homepage start back menu search browse go return visit check try reload refresh wait loading load open opened view viewer viewing see show shown display displayed use using properly work works run running render rendering fetch fetching reach ask asking asked looking look follow followed reach kept keep
notice warning attention error errors code message status problem issue technical details id reference http https html www com org few minutes minute moment moments seconds second hour hours time times day days this's currently temporarily unfortunately unexpected internal another other different correct wrong exact spelling typed entered moved deleted removed renamed expired available unavailable longer exist exists allowed permission permissions private public access continue view javascript java script scripts scripting enable enabled disable disabled settings options turned switched off on cookies all more some any own new old just only still first next contact working seems looks like happens nothing something anything
repository repositories project projects folder item items article post entry record output outputs cell cells preview previews widget widgets embed embedded interactive raw full original source incident ticket trace origin upstream backend gateway proxy cache service services database
us me before after until instead right download downloading upload opened opening ended ending ends expired closed lost kept keep keeping showing saw seen found finding got getting still already many much very way back one two three every each other others own part parts large big small allowed asked visit visits visiting
nginx apache cloudflare iis varnish openresty tomcat squid
text title heading paragraph section sentence words word caption summary description introduction conclusion name date abstract body copy sample placeholder example dummy template author insert add write replace describe edit click
"""
#: language: telling phrases; plain words or stems.
OTHERS = {
    "German": (
        "nicht (gefunden|verfügbar|erreichbar|geladen|angezeigt|geöffnet|vorhanden|unterstützt|mehr verfügbar|mehr vorhanden); existiert nicht (mehr|); (konnte|kann|konnten) nicht (gefunden|geladen|angezeigt|geöffnet|dargestellt) werden; wurde (gelöscht|entfernt|verschoben|deaktiviert); zugriff verweigert; kein(e|en|) (zugriff|berechtigung|zugang); (interner |)serverfehler; (ist |)ein (unerwarteter |interner |)fehler (ist |)(aufgetreten|); fehler aufgetreten; zeitüberschreitung; (sitzung|link) (ist |)(abgelaufen|defekt|ungültig); zu viele anfragen; (derzeit|momentan|vorübergehend|zurzeit) nicht; wartungsarbeiten; (später|bitte) (erneut|noch einmal|nochmal|noch einmal später|später erneut) (versuchen|); versuchen sie es (später|erneut|noch); bitte (melden|loggen) sie sich; (aktivieren|erlauben|schalten) sie (javascript|skripte|cookies); (javascript|skripte) (ist |sind |in ihrem browser |muss |müssen |)(deaktiviert|erforderlich|aktivieren|aktiviert|erlauben|ausgeschaltet|blockiert|aktiviert sein); (benötigt|erfordert|braucht|ohne|führt keine) (eingeschaltete |aktivierte |aktives |)(javascript|skripte); (platzhalter|blind|muster|beispiel|füll)text; platzhalter; (text|inhalt|titel) (folgt|hier einfügen|hier eingeben|einfügen); hier (steht|kommt|folgt|text|den text|ihr|ihren text) ; (ihr|dein) text hier",
        "die der das den dem diese dieser dieses dieses seite datei notizbuch notebook dokument inhalt link server browser ihr ihre ihrem ihren sie wir uns es ist sind war wurde wird werden kann konnte leider bitte entschuldigung ein eine einen einem einige minuten später erneut noch mal und oder um zu zum zur im in auf für von mit ohne an anzuzeigen anzeigen öffnen sehen javascript skripte einstellungen gesuchte angeforderte aufgerufene gewünschte nicht hier text titel einfügen mehr fehler keine aktivieren laden neu",
    ),
    "French": (
        "(page|fichier|document|carnet|notebook|ressource|contenu) (introuvable|inexistant|inexistante|non trouvée|non trouvé|indisponible|supprimé|supprimée); introuvable; n'existe (pas|plus); n'(est|a) (pas|plus) (disponible|été trouvé|été trouvée|pu être|accessible); (est|actuellement|temporairement|service) indisponible; a été (supprimé|supprimée|déplacé|déplacée|retiré|retirée); accès (refusé|interdit|non autorisé); (vous |)n'avez pas (accès|la permission|l'autorisation|les droits); erreur (interne|serveur|du serveur|inattendue|est survenue|s'est produite|500|404|403); une erreur (interne |inattendue |)(est survenue|s'est produite|); en maintenance; délai (d'attente |)dépassé; (session|lien) (a |est |)(expiré|expirée|rompu|cassé|invalide); trop de (requêtes|demandes|visiteurs); (réessayez|réessayer|veuillez réessayer|essayez|revenez) (plus tard|ultérieurement|dans); veuillez (vous connecter|activer|réessayer|patienter); (activer|activez|autorisez|autoriser|nécessite|requiert|sans) (le |les |)(javascript|scripts); (javascript|scripts) (est |sont |doit être |doivent être |)(désactivé|désactivés|requis|nécessaire|activé|activés|bloqués); n'exécute pas (les |de |)scripts; (texte|exemple) (factice|fictif|à remplacer|de remplissage|d'exemple|ici|de texte); faux texte; (insérer|insérez|saisissez|écrivez|ajoutez|entrez) (le|votre|un|du|ici|la) (texte|titre|contenu|description|image|); votre (texte|titre) ici; à (compléter|remplir|rédiger)",
        "le la les l un une des du de d ce cet cette ces page fichier carnet notebook document site lien serveur navigateur contenu vous votre vos nous notre que qui quoi pour dans sur par avec sans et ou est sont a été être avez avons plus pas ne n désolé désolée oups veuillez merci recherchez demandez demandée demandé cherchez afficher voir lire ouvrir continuer javascript scripts texte titre ici tard quelques minutes erreur activer",
    ),
    "Spanish": (
        "no (se |ha sido |fue |pudo ser |se ha |se pudo |ha podido ser |está |se encuentra )(encontró|encontrado|encontrada|encontrar|disponible|cargar|mostrar|abrir|mostrarse); no (encontrada|encontrado|existe|disponible|disponibles); ya no (existe|está|se encuentra); (ha sido|fue) (eliminado|eliminada|movido|movida|borrado|borrada); acceso (denegado|prohibido|no autorizado); no tiene (permiso|permisos|acceso|autorización); error (interno|del servidor|interno del servidor|en el servidor|inesperado|404|500|403); (se ha producido|ha ocurrido|ocurrió|se produjo) un (error|problema); en mantenimiento; tiempo de espera (agotado|excedido); (sesión|enlace) (ha |está |)(caducado|expirado|roto|caducada|expirada); demasiadas (solicitudes|peticiones); (inténtelo|inténtalo|intente|vuelva a|vuelve a|intentar) (de nuevo|nuevamente|más tarde|otra vez|intentarlo); (inicie|inicia) sesión; (active|activa|activar|habilite|habilita|habilitar|permita|permitir|requiere|necesita|sin) (el |los |)(javascript|scripts); (javascript|scripts) (está |están |debe estar |)(desactivado|deshabilitado|desactivados|habilitado|activado|requerido); no ejecuta scripts; texto (de relleno|ficticio|simulado|de ejemplo|de muestra|provisional|aquí); ejemplo de texto; (inserte|inserta|escriba|escribe|ingrese|añada|agregue) (el |su |tu |un |aquí |la )(texto|título|contenido|descripción|imagen|); (su|tu) (texto|título) aquí; por completar; marcador de posición",
        "el la los las un una unos de del al a en para por con sin y o que se su sus tu este esta esto página archivo cuaderno notebook documento sitio enlace servidor navegador contenido lo le nos es está están ha sido no más tarde favor perdón lo sentimos ups busca solicitada solicitado buscada ver mostrar abrir continuar javascript scripts actívelos texto título aquí minutos unos error de nuevo",
    ),
    "Portuguese": (
        "não (foi |pôde ser |está |foi possível )(encontrada|encontrado|carregado|carregada|exibido|disponível|carregar|exibir|abrir|encontrar); não (encontrada|encontrado|existe|disponível); já não existe; (foi) (removido|removida|excluído|movido|movida|apagado); acesso (negado|proibido|não autorizado); (você |)não tem (permissão|acesso|autorização); erro (interno|do servidor|no servidor|interno do servidor|inesperado|404|500|403); (ocorreu|aconteceu|houve) um erro; (serviço|temporariamente) indisponível; em manutenção; tempo (limite|de espera) (esgotado|excedido); (sessão|link) (expirou|expirada|quebrado|está quebrado); muitas (solicitações|requisições); (tente|tentar) (novamente|de novo|mais tarde); (ative|ativar|habilite|habilitar|permita|requer|precisa de|sem) (o |os |)(javascript|scripts); (javascript|scripts) (está |estão |deve estar |)(desativado|desabilitado|desativados|habilitado|ativado); não executa scripts; texto (fictício|de preenchimento|de exemplo|provisório|aqui); exemplo de texto; (insira|escreva|digite|adicione) (o |seu |um |aqui |a )(texto|título|conteúdo|descrição|imagem|); seu (texto|título) (aqui|aqui); a completar; espaço reservado",
        "o a os as um uma de do da dos das em no na para por com sem e ou que se seu sua este esta isto página arquivo caderno notebook documento site link servidor navegador conteúdo é está estão foi ser não mais tarde favor desculpe ops procura solicitada você ver exibir abrir continuar javascript scripts texto título aqui minutos alguns erro novamente ativos continuar",
    ),
    "Italian": (
        "non (è stata |è stato |è |può essere |esiste |)(trovata|trovato|disponibile|caricato|caricata|visualizzato|raggiungibile); non esiste (più|); (è stata|è stato) (rimossa|rimosso|eliminata|eliminato|spostata|spostato); accesso (negato|vietato|non autorizzato); non (hai|ha|si dispone) (il permesso|i permessi|accesso|dell'autorizzazione); errore (interno|del server|interno del server|imprevisto|404|500|403); si è verificato un (errore|problema); (servizio|temporaneamente) non disponibile; in manutenzione; (sessione|link) (è |)(scaduta|scaduto|interrotto); troppe richieste; (riprova|riprovare|riprovi) (più tardi|di nuovo|tra|); (abilita|abilitare|attiva|attivare|richiede|senza) (il |gli |)(javascript|script); javascript (è |deve essere |)(disabilitato|disattivato|abilitato|richiesto|necessario); testo (segnaposto|di esempio|fittizio|provvisorio|qui); (inserisci|inserire|scrivi|aggiungi) (qui |il |un |la |)(testo|titolo|contenuto|descrizione|il testo); il tuo testo qui; da completare",
        "il lo la i gli le un una di del della dei in nel nella per con senza e o che si questa questo pagina file documento sito link server browser contenuto è sono stata stato non più tardi favore spiacenti ops cerchi richiesta richiesto vedere visualizzare aprire continuare javascript script testo titolo qui minuti alcuni errore tuo",
    ),
    "Dutch": (
        "niet (gevonden|beschikbaar|geladen|weergegeven|bereikbaar|geopend|ondersteund); bestaat niet (meer|); is (verwijderd|verplaatst); toegang (geweigerd|verboden); geen (toegang|toestemming|rechten); (interne |)serverfout; er is (een fout|iets) (opgetreden|misgegaan|fout gegaan); in onderhoud; (sessie|link) (is |)(verlopen|verbroken); te veel (verzoeken|aanvragen); probeer het (later|opnieuw|nog); (schakel|zet) (javascript|scripts) (in|aan); (javascript|scripts) (is |zijn |moet |)(uitgeschakeld|vereist|ingeschakeld); (vereist|zonder) javascript; (voorbeeld|plaatshouder|opvul)tekst; (uw|jouw) tekst hier; (voeg|voer|typ) (hier |de |uw |)(tekst|titel) (in|toe|); nog in te vullen",
        "de het een deze dit die van voor op in met zonder en of uw je wij u pagina bestand document site link server browser inhoud is zijn niet later opnieuw helaas sorry oeps gevraagde opgevraagde bekijken weergeven openen javascript scripts tekst titel hier minuten fout alstublieft",
    ),
    "Polish": (
        "nie (znaleziono|została znaleziona|został znaleziony|istnieje|można|jest dostępna|jest dostępny|udało się) ; (strona|plik|dokument) nie (istnieje|została|został|jest); (została|został) (usunięta|usunięty|przeniesiona|przeniesiony); odmowa dostępu; brak (dostępu|uprawnień); (wewnętrzny |)błąd serwera; (wystąpił|napotkano) (nieoczekiwany |)błąd; coś poszło nie tak; (sesja|link) (wygasła|wygasł|jest uszkodzony); zbyt wiele (żądań|zapytań); spróbuj ponownie; prace konserwacyjne; (włącz|aktywuj|wymaga|bez) (obsługę |)(javascript|javascriptu|skrypty); (javascript|skrypty) (jest |są |)(wyłączona|wyłączony|wymagany|wyłączone); tekst (zastępczy|przykładowy|wypełniający); (przykładowy|twój) tekst; (wpisz|wstaw|dodaj) (tutaj |tu |swój |)(tekst|tytuł|treść); do uzupełnienia",
        "strona strony stronę plik dokument serwer przeglądarka przeglądarce w na i lub z do że jest są nie ten ta to się prosimy proszę przepraszamy później ponownie szukasz żądana której którą aby wyświetlić zobaczyć javascript tekst tytuł tutaj błąd kilka minut",
    ),
    "Czech": (
        "(stránka|soubor|dokument) (nenalezena|nenalezen|nebyla nalezena|nebyl nalezen|neexistuje|není k dispozici); (nebyla|nebyl|nelze) (nalezena|nalezen|načíst|zobrazit); byla odstraněna; přístup (odepřen|zamítnut|zakázán); (interní |)chyba serveru; došlo k (chybě|neočekávané chybě); zkuste to (později|znovu|prosím); relace vypršela; příliš mnoho požadavků; (povolte|zapněte|vyžaduje|bez) javascript; javascript (je |)(vypnutý|zakázán|vyžadován); (ukázkový|zástupný|výplňový|vzorový) text; (vložte|zadejte|napište) (sem |zde |)(text|název); váš text zde; doplnit text",
        "stránka stránku soubor dokument server prohlížeč prohlížeči na v a nebo se je není tato toto prosím omlouváme později znovu hledáte požadovaná kterou zobrazení javascript text zde chyba",
    ),
    "Swedish": (
        "(kunde inte|kan inte) (hittas|visas|laddas|öppnas|nås); hittades inte; finns inte (längre|); inte tillgänglig; har (tagits bort|flyttats); åtkomst nekad; saknar behörighet; internt serverfel; serverfel; ett (oväntat |)fel (uppstod|har uppstått|inträffade); något gick fel; försök igen; för många förfrågningar; (sessionen|länken) (har gått ut|är bruten); (aktivera|slå på|kräver|utan) javascript; javascript (är |)(inaktiverat|avstängt|krävs); (exempel|platshållar|utfyllnads)text; din text här; (infoga|skriv|lägg till) (din |)(text|titel|rubrik) här; kommer snart",
        "sidan filen dokumentet servern webbläsare webbläsaren i på och eller som du din den det är inte vi vänligen tyvärr hoppsan senare igen söker begärda visa se javascript text här fel några minuter att för",
    ),
    "Danish, Norwegian": (
        "(blev ikke|ble ikke|kunne ikke|kan ikke) (fundet|funnet|vises|indlæses|lastes|åpnes); (findes|finnes) ikke; ikke (tilgængelig|tilgjengelig); (adgang|tilgang) (nægtet|nektet); ingen (adgang|tilgang); (intern |)(serverfejl|serverfeil|tjenerfeil); der opstod en (uventet |)fejl; det oppstod en (uventet |)feil; noget gik galt; noe gikk galt; (prøv|forsøg) (igen|igjen); (aktiver|slå|kræver|krever|uden|uten) javascript; javascript er (deaktiveret|deaktivert|slået fra|slått av|påkrævet|påkrevd); (eksempel|pladsholder|plassholder)tekst; din tekst her; (indsæt|sett inn|skriv) (din |)(tekst|titel|tittel) her; kommer snart",
        "siden filen dokumentet serveren browseren nettleseren i på og eller som du din den det er ikke vi venligst vennligst desværre dessverre ups senere igen igjen søger leter vise se javascript tekst her fejl feil minutter at å for",
    ),
    "Finnish": (
        "ei (löytynyt|löydy|ole olemassa|ole saatavilla|ole käytettävissä|voitu ladata|voida näyttää); pääsy (estetty|evätty|kielletty); palvelinvirhe; (tapahtui|ilmeni) (odottamaton |)virhe; jokin meni pieleen; yritä (myöhemmin |)uudelleen; (ota|vaatii) javascript (käyttöön|); javascript (on |)(pois käytöstä|estetty); (esimerkki|paikkamerkki|täyte)teksti; (kirjoita|lisää|syötä) (teksti|otsikko) tähän; tekstisi tähän; tulossa pian",
        "sivua sivu tiedostoa tiedosto palvelin selain selaimessa etsimääsi pyydettyä on ei ja tai valitettavasti hups myöhemmin ole hyvä javascript teksti tähän virhe",
    ),
    "Hungarian": (
        "nem (található|létezik|érhető el|elérhető|tölthető be|jeleníthető meg); hozzáférés megtagadva; (belső |)(szerverhiba|kiszolgálóhiba); (váratlan |)hiba (történt|lépett fel); próbálja (újra|meg); túl sok kérés; lejárt a munkamenet; (engedélyezze|kapcsolja be|szükséges) a javascript(et|); a javascript (le van tiltva|ki van kapcsolva); (minta|helykitöltő|példa)szöveg; (írja|illessze) (ide |be )a szöveget; szöveg helye",
        "az a oldal fájl dokumentum szerver böngésző böngészőben és vagy hogy ez nem kérjük sajnáljuk később újra keresett kért javascript szöveg ide hiba",
    ),
    "Romanian": (
        "nu (a fost găsită|a fost găsit|există|este disponibilă|este disponibil|poate fi); a fost (ștearsă|șters|mutată); acces (interzis|refuzat); eroare (internă|de server|internă a serverului); a apărut o (eroare|problemă); încercați (din nou|mai târziu); (activați|necesită|fără) javascript; javascript este dezactivat; text (de exemplu|substituent|de umplutură); introduceți (aici |)textul; textul (dumneavoastră|tău) aici",
        "pagina fișierul documentul serverul browserul și sau pe în de la că este nu vă rugăm ne pare rău mai târziu din nou căutată solicitată javascript text aici eroare",
    ),
    "Turkish": (
        "(bulunamadı|bulunamıyor|yüklenemedi|görüntülenemiyor|açılamadı); mevcut değil; artık (yok|mevcut değil); (kaldırıldı|silinmiş|taşınmış); erişim (engellendi|reddedildi|yasak); (sunucu|dahili sunucu) hatası; (beklenmeyen |)bir hata oluştu; bir şeyler (ters|yanlış) gitti; (tekrar|yeniden) deneyin; çok fazla istek; oturum(unuzun|unuz|) süresi doldu; javascript('i|) (etkinleştirin|etkinleştirmeniz|gerekli|devre dışı|kapalı); (örnek|yer tutucu|dolgu|temsili) metin; metin(inizi|) buraya; buraya (metin|yazın|yazınızı); yakında",
        "sayfa sayfası dosya belge sunucu tarayıcı tarayıcınızda ve veya bu bir aradığınız istenen lütfen üzgünüz daha sonra tekrar için görüntülemek javascript metin buraya hata",
    ),
    "Greek": (
        "δεν (βρέθηκε|υπάρχει|είναι διαθέσιμη|είναι διαθέσιμο|επιτρέπεται|μπορεί); (απαγορεύεται|δεν επιτρέπεται) η πρόσβαση; (εσωτερικό |)σφάλμα (διακομιστή|); παρουσιάστηκε (ένα |)(σφάλμα|πρόβλημα); δοκιμάστε (ξανά|πάλι|αργότερα); ενεργοποιήστε (το|τη|την) javascript; (απαιτείται|χωρίς) javascript; (δείγμα|παράδειγμα) κειμένου; κείμενο (κράτησης θέσης|υποκατάστασης|εδώ); εισαγάγετε (το |)κείμενο; το κείμενό σας εδώ",
        "η ο το τη την της του σελίδα αρχείο έγγραφο διακομιστής πρόγραμμα περιήγησης και ή σας που δεν είναι παρακαλώ λυπούμαστε αργότερα ξανά ζητήσατε αναζητάτε javascript κείμενο εδώ",
    ),
    "Russian": (
        "не (найдена|найден|найдено|существует|удалось|может быть|доступна|доступен|отвечает|выполняет скрипты); (такой|этой) страницы (нет|не существует); (была |был |)(удалена|удалён|удален|перемещена|перемещен); доступ (запрещен|запрещён|закрыт|ограничен); (нет|недостаточно) (доступа|прав); (внутренняя |произошла |)ошибка сервера; (произошла|возникла) (непредвиденная |неизвестная |)ошибка; что-то пошло не так; (сервис|сервер|страница|сайт) (временно |)(недоступен|недоступна|не отвечает); (технические|профилактические) работы; время (ожидания |)(истекло|вышло); (сессия|ссылка) (истекла|не работает|устарела); слишком много (запросов|посетителей); (попробуйте|повторите|зайдите) (позже|ещё раз|еще раз|попытку|снова|позднее); (войдите|авторизуйтесь) (в|чтобы|снова); (включите|разрешите|требуется|необходим|нужен|без|поддержку) (поддержку |)(javascript|скрипты|скриптов); (javascript|скрипты|скриптов) (в браузере |)(отключен|отключён|отключены|выключен|выключены|заблокированы); (текст|рыба)-(рыба|заглушка|текст|заполнитель); текст(-| )заглушка; (вставьте|введите|напишите|добавьте) (сюда |здесь |ваш |)(текст|заголовок|название|описание); (образец|пример) текста; (ваш|здесь будет|тут будет) текст; заполните этот раздел",
        "страница страницу страницы файл файла блокнот блокнота документ сайт ссылка сервер браузер браузере вашем ваш эта этот это вы мы нас на в во с и или к по для чтобы что которую запрошенная запрошенный просмотреть открыть посмотреть увидеть пожалуйста извините к сожалению позже ещё раз снова скрипты javascript включите не нет была текст здесь ошибка минут несколько через",
    ),
    "Ukrainian": (
        "не (знайдено|знайдена|існує|вдалося|доступна|доступний); доступ (заборонено|обмежено); (внутрішня |)помилка сервера; (сталася|виникла) (неочікувана |)помилка; щось пішло не так; (спробуйте|повторіть) (пізніше|ще раз|спробу); (увімкніть|потрібен|без) (підтримку |)javascript; (зразок|приклад) тексту; текст-заповнювач; (вставте|введіть) (сюди |)текст; ваш текст тут",
        "сторінка сторінку сторінки файл документ сервер браузер браузері і або на в у що ця цей ви ми будь ласка вибачте пізніше ще раз запитана javascript текст тут помилка",
    ),
    "Vietnamese": (
        "không (tìm thấy|tồn tại|có sẵn|khả dụng|thể tải|thể hiển thị|có quyền); (truy cập|quyền truy cập) bị từ chối; lỗi (máy chủ|hệ thống); đã xảy ra lỗi; đã (xảy ra|có) lỗi; (thử|vui lòng thử) lại (sau|); quá nhiều yêu cầu; (bật|cần|yêu cầu) javascript; javascript (bị tắt|đã bị tắt|đang tắt); (văn bản|nội dung) (mẫu|giữ chỗ|giả); (nhập|chèn|thêm) (văn bản|nội dung) (vào |ở |tại |)đây",
        "trang tệp tài liệu máy chủ trình duyệt của bạn và hoặc này đã bị được vui lòng xin lỗi sau lại để xem tiếp tục yêu cầu javascript văn bản đây lỗi",
    ),
    "Indonesian, Malay": (
        "tidak (ditemukan|dijumpai|tersedia|dapat dimuat|dapat ditampilkan|ada); (akses|capaian) (ditolak|dilarang); (terjadi|ada) (kesalahan|galat|masalah); kesalahan (server|peladen); (silakan |)coba lagi; terlalu banyak permintaan; sesi (telah |)berakhir; (aktifkan|memerlukan|butuh|tanpa) javascript; javascript (dinonaktifkan|tidak aktif); (contoh teks|teks contoh|teks pengisi|teks tiruan); (masukkan|tulis|isi) (teks|judul|konten) (anda |)di sini; teks anda di sini; segera hadir",
        "halaman laman berkas dokumen server peramban browser anda yang dan atau ini itu di untuk maaf mohon nanti lagi melihat menampilkan cari diminta javascript teks sini kesalahan",
    ),
    "Korean": (
        "(찾을 수|표시할 수|불러올 수|열 수|연결할 수) 없습니다; 존재하지 않(습니다|는); (삭제|이동)되었(습니다|거나); (접근|액세스)(이|가) (거부|제한|차단)되; 권한이 없습니다; (서버|내부 서버) 오류; 오류가 발생; 문제가 발생; (나중에|잠시 후) 다시; 다시 시도; 요청이 너무 많; 세션이 만료; 점검 중; (javascript|자바스크립트|스크립트)(를|을) (활성화|사용|허용|켜); (javascript|자바스크립트)(가|이) (필요|비활성화|꺼져); (예시|샘플|자리 표시자|더미) 텍스트; (여기에|이곳에) (텍스트|내용|제목|글)(를|을) (입력|작성|추가); 내용을 입력하세요",
        "페이지 페이지를 파일 파일을 문서 노트북 노트북을 서버 브라우저 브라우저에서 이 요청하신 요청한 죄송합니다 보려면 표시하려면 주세요 해주세요 주십시오 하세요 javascript 자바스크립트 텍스트 여기에",
    ),
    "Japanese": (
        "見つかりません; 存在しません; 表示できません; 読み込めません; (削除|移動)(され|した); アクセスが(拒否|禁止|制限); アクセスできません; 権限が(ありません|ない); (サーバー|内部サーバー|サーバ)エラー; エラーが発生; 問題が発生; (しばらく|後で|後ほど)(して|経って|)(から|)(もう一度|再度|お試し|); もう一度お試し; メンテナンス中; ご利用いただけません; タイムアウト; セッションの有効期限; リクエストが多すぎ; (リンク)(が|は)(切れ|無効); (javascript|スクリプト|javascript )(を|が)(有効|無効|必要|許可|オン|オフ|実行|ブロック); (javascript|スクリプト) (を|が)(有効|無効|必要|許可|オン|オフ); (ダミー|サンプル|仮の|仮|プレースホルダー)(テキスト|文章|本文); ここに(本文|説明|文章|テキスト|内容|タイトル|文字|画像)(を|が|); (テキスト|文章|本文)(が入ります|を入力)",
        "お探しの ご指定の この その ページ ファイル ノートブック 文書 サイト サーバー ブラウザ が は を に で の と も から まで ため には ください お試し ください 申し訳 ございません ありません ました です ます して する もう一度 表示 有効 設定 しばらく 後で javascript スクリプト 本文 説明 文章 入力 入ります",
    ),
    "Chinese": (
        "(未找到|找不到|沒有找到|没有找到|无法找到)(该|此|您|頁面|页面|文件|檔案|笔记本|); (页面|頁面|文件|檔案|笔记本|网页|網頁|链接)(不存在|未找到|已删除|已失效|找不到|無法顯示|无法显示|无法访问|已移动); 不存在; (拒绝|拒絕)(访问|存取|訪問); (访问|存取|訪問)(被拒绝|被拒絕|受限); (没有|沒有|无|無)(权限|權限|访问权限); (服务器|伺服器)(内部|內部|)(错误|錯誤|发生错误|發生錯誤|出错|繁忙); (发生|發生|出现|出現)(错误|錯誤|了错误|未知错误|意外); 出错了; (服务|服務)(不可用|暫時不可用|暂时不可用|暂不可用); (系统|系統|正在)(维护|維護); (请求|連線|连接)(超时|逾時|过多|失败|失敗); (会话|工作階段)(已过期|已過期); (请|請|)(稍后|稍後)(再试|再試|重试|重試|访问); (启用|啟用|开启|開啟|需要|允许|允許|打开|支持|禁用了|禁用)( |)(javascript|脚本|腳本|js); (javascript|脚本|腳本)( |)(已禁用|被禁用|已停用|未启用|已关闭); (占位|占位符|示例|示範|范例|範例|虚拟|填充|样本|測試)(文本|文字|内容); (在此|此处|此處|这里|這裡|請在此|请在此)(输入|填写|添加|插入|輸入|填寫|是示例|放置)(文字|文本|内容|標題|标题|內容|); (请|請)(输入|輸入)(内容|文字|標題|内容)",
        "您 你 请 請 的 了 该 此 这 這 个 個 在 是 我们 页面 頁面 网页 文件 笔记本 链接 网站 服务器 浏览器 瀏覽器 访问 查看 显示 要 以 才能 才 能 后 後 再 已 被 或 和 与 抱歉 对不起 很 稍后 重试 错误 脚本 javascript 启用 文字 内容 输入",
    ),
    "Arabic": (
        "(الصفحة|الملف|المستند) غير (موجودة|موجود|متاحة|متاح); لم يتم العثور على; (تم رفض|رفض|ممنوع) الوصول; ليس لديك (إذن|صلاحية); خطأ (في الخادم|داخلي|غير متوقع); حدث خطأ; (حاول|يرجى المحاولة|أعد المحاولة) (مرة أخرى|لاحقا|لاحقًا|مرة); (تفعيل|تمكين|يتطلب|بدون) (جافا سكريبت|javascript|جافاسكريبت); (جافا سكريبت|javascript) (معطل|معطلة|غير مفعل); نص (تجريبي|عشوائي|افتراضي|بديل|مثال); (أدخل|اكتب|ضع) (النص|نصك|العنوان) هنا",
        "الصفحة الملف المستند الخادم المتصفح التي الذي تبحث عنها طلبتها في من على إلى أو و هذا هذه عذرا عذرًا يرجى لاحقا لعرض javascript النص هنا خطأ",
    ),
    "Hebrew": (
        "(הדף|העמוד|הקובץ|המסמך) לא (נמצא|קיים|זמין); הגישה (נדחתה|נחסמה); אין (לך |)(הרשאה|גישה); שגיאת שרת; (אירעה|התרחשה) שגיאה; נסה שוב; נסו שוב; (הפעל|יש להפעיל|נדרש) javascript; טקסט (לדוגמה|זמני|דמה); (הכנס|הזן|כתוב) (כאן |)טקסט",
        "הדף העמוד הקובץ השרת הדפדפן שביקשת המבוקש של את על או זה זו אנא מצטערים מאוחר יותר שוב javascript טקסט כאן שגיאה",
    ),
    "Hindi": (
        "(नहीं मिला|नहीं मिली|उपलब्ध नहीं है|मौजूद नहीं है); (पहुँच|पहुंच|प्रवेश) (अस्वीकृत|निषिद्ध|वर्जित); (सर्वर|एक|आंतरिक) (त्रुटि|सर्वर त्रुटि|त्रुटि हुई); त्रुटि हुई; (पुनः|फिर से|दोबारा) (प्रयास|कोशिश) करें; (जावास्क्रिप्ट|javascript) (सक्षम|चालू|आवश्यक|अक्षम); (नमूना|उदाहरण) (पाठ|टेक्स्ट); यहाँ (पाठ|टेक्स्ट|अपना) ",
        "पृष्ठ पेज फ़ाइल दस्तावेज़ सर्वर ब्राउज़र यह वह आप जो है का की के में को और या कृपया क्षमा बाद करें javascript यहाँ एक",
    ),
    "Thai": (
        "ไม่พบ(หน้า|ไฟล์|เอกสาร|); (การเข้าถึงถูก|ปฏิเสธการ)(ปฏิเสธ|เข้าถึง); เกิดข้อผิดพลาด; (โปรด|กรุณา)ลองอีกครั้ง; ลองใหม่; (เปิดใช้งาน|ต้องใช้) javascript; (ข้อความ|เนื้อหา)(ตัวอย่าง|จำลอง); (ใส่|พิมพ์|กรอก)(ข้อความ|เนื้อหา)ที่นี่",
        "หน้า ไฟล์ เอกสาร เซิร์ฟเวอร์ เบราว์เซอร์ ที่ คุณ ร้องขอ ค้นหา โปรด กรุณา ขออภัย ภายหลัง เพื่อ ดู และ หรือ นี้ javascript ใน ของ",
    ),
}
#: The words of the classical filler passage and of its usual continuations.
LOREM = """
lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat
duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum
vivamus vestibulum curabitur pellentesque maecenas phasellus suspendisse praesent aliquam vitae mauris ligula quam semper egestas turpis tristique senectus netus malesuada fames porttitor rhoncus lacus vel pharetra
cupcake bacon gummies tiramisu marshmallow jujubes cotton candy brownie
"""


def expanded(rule: str) -> set[str]:
    """All phrases of a rule; groups may lie within groups."""
    todo, done = {rule}, set()
    while todo:
        r = todo.pop()
        m = re.search(r"\(([^()]*)\)", r)
        if m:
            todo.update(r[: m.start()] + part + r[m.end() :] for part in m[1].split("|"))
        else:
            done.add(re.sub(r" +", " ", r).strip())
    return done


def telling() -> set[str]:
    """Telling phrases of all languages."""
    rules = [r for block in [ENGLISH, *(t for t, _ in OTHERS.values())] for line in block.split("\n") for r in line.split(";")]
    return {p for r in rules for p in expanded(r) if len(p) > 1}


def plain() -> tuple[frozenset[str], list[str]]:
    """Plain words, and those of the scripts that are written without blanks."""
    words = set(ENGLISH_PLAIN.split()) | {w for _, text in OTHERS.values() for w in text.split()}
    joined = [w for w in words if any("぀" <= c <= "鿿" or "฀" <= c <= "๿" or "가" <= c <= "힣" for c in w)]
    return frozenset(words), sorted(joined, key=len, reverse=True)
